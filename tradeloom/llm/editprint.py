"""Document fingerprints by randomised edit embedding.

A walk reads a text one character a step and moves on to the next character, or stays, as a random bit shared by
all documents and given by the step and the character tells. What it reads is the embedding: texts a few edits
apart soon walk in step again, so their embeddings differ in few places, while the walk covers the whole text.
The fingerprint samples the embedding: as many steps from each octave, a hex digit for each.

Fingerprints of the same prefix length compare digit by digit, octaves weighted by their length. Bands of sampled
digits find documents that are near each other (``near_pairs``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.components import components
from tradeloom.llm.frames import bounded_batches, keep, partitions

OCTAVES = 40
FIRST = 64  # steps of the first octave; each further octave ends at twice the step of the one before
DIGITS = 32  # sampled from each octave
PERIOD = 4096  # after so many steps the shared bits come round again
PAST_END = "."
BUFFER = 12_000_000  # characters of documents fingerprinted together, unless they are so many:
BUFFER_ROWS = 4000
CHECK_EVERY = 128
CHUNKS_PER_PARTITION = 4
BLOCK = 256  # members of a bucket held against as many others at once

_random = np.random.default_rng(20240602)
#: By step and character code: whether the walk moves on. Code 0 stands for the end, where it stays.
MOVES = _random.integers(0, 2, (PERIOD, 256), dtype=np.uint8)
MOVES[:, 0] = 0
#: By sampled step and character code: the digit.
SYMBOLS = np.array([ord(c) for c in "0123456789abcdef"], np.uint8)[_random.integers(0, 16, (OCTAVES * DIGITS, 256))]
SYMBOLS[:, 0] = ord(PAST_END)
LENGTHS = np.array([FIRST] + [FIRST << o for o in range(OCTAVES - 1)], float)
_starts = np.concatenate([[0], np.cumsum(LENGTHS)[:-1]]).astype(np.int64)
SAMPLED = np.concatenate([
    start + np.sort((np.arange(DIGITS) + _random.random(DIGITS)) * (length / DIGITS)).astype(np.int64)
    for start, length in zip(_starts, LENGTHS)
])


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A code of 1 to 255 for each character, each text followed by a 0; and where the texts start."""
    parts = []
    for text in texts:
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        parts.append((points * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(255) + np.uint32(1))
        parts.append(np.zeros(1, np.uint32))
    codes = np.concatenate([p.astype(np.uint8) for p in parts])
    ends = np.flatnonzero(codes == 0)
    return codes, np.concatenate([[0], ends[:-1] + 1])


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of each text, all texts walking together; that of an empty text is empty."""
    if not texts:
        return []
    codes, position = codes_of(texts)
    here = np.arange(len(texts))
    digits = np.full((len(texts), len(SAMPLED)), ord(PAST_END), np.uint8)
    step = sample = 0
    reading = np.empty(len(here), np.uint8)
    moving = np.empty(len(here), np.uint8)
    while len(here):
        for step in range(step, step + CHECK_EVERY):
            np.take(codes, position, out=reading, mode="clip")
            if step == SAMPLED[sample]:
                while sample < len(SAMPLED) and step == SAMPLED[sample]:
                    digits[here, sample] = SYMBOLS[sample][reading]
                    sample += 1
            np.take(MOVES[step % PERIOD], reading, out=moving, mode="clip")
            np.add(position, moving, out=position)
        step += 1
        going = codes[position] != 0
        if not going.all():
            here, position = here[going], position[going]
            reading, moving = reading[:len(here)].copy(), moving[:len(here)].copy()
    return [row.tobytes().decode().rstrip(PAST_END) for row in digits[:, :max(sample, 1)]]


def likeness(one: list[str], other: list[str]) -> np.ndarray:
    """How much of the embeddings of each two fingerprints agrees, 0 to 1, corrected for digits equal by chance.

    Two empty fingerprints are alike; an empty one and another are not.
    """
    out = np.ones(len(one))
    for i, (a, b) in enumerate(zip(one, other)):
        if a == b:
            continue
        octaves = -(-max(len(a), len(b)) // DIGITS)
        width = octaves * DIGITS
        x = np.frombuffer(a.ljust(width, PAST_END).encode(), np.uint8).reshape(octaves, DIGITS)
        y = np.frombuffer(b.ljust(width, PAST_END).encode(), np.uint8).reshape(octaves, DIGITS)
        live = (x != ord(PAST_END)) | (y != ord(PAST_END))
        weight = LENGTHS[:octaves]
        raw = (weight * ((x == y) & live).sum(1)).sum() / (weight * live.sum(1)).sum()
        out[i] = min(1.0, max(0.0, (raw - 1 / 16) / (15 / 16)))
    return out


def edited(text: str, following: str) -> str:
    """``text`` with the last quarter of its characters replaced by as many, or all, of the following text."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, text, next text) of every own row, from rows (chunk, borrowed, place, key, text) in order."""
    last = None
    for batch in batches:
        for chunk, borrowed, key, text in zip(*(batch.column(n).to_pylist() for n in ("chunk", "borrowed", "key", "text"))):
            if last and last[0] == chunk:
                yield last[1], last[2], text
            last = None if borrowed else (chunk, key, text)


def _digest(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    """Output rows of a run of rows (key, text, next text)."""
    keys, texts, following = zip(*rows)
    changed = [edited(t, n) for t, n in zip(texts, following)]
    of = {t: i for i, t in reversed(list(enumerate(texts)))}
    borrowed = [t for t in dict.fromkeys(following) if t not in of]
    prints = fingerprints([*texts, *changed, *borrowed])
    own, after = prints[:len(rows)], prints[len(rows):2 * len(rows)]
    of.update({t: 2 * len(rows) + i for i, t in enumerate(borrowed)})
    columns = [
        pa.array(keys, kind), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), pa.array(own), pa.array(after),
        pa.array(likeness(own, after)), pa.array(likeness(own, [prints[of[n]] for n in following])),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names)


def fingerprint_documents(df: DataFrame, key: str, text: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next text.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next document
    is that with the next key, after the last the first; a single one is its own next. Null keys come first, rows of
    equal keys follow one another in the order of their texts. A null text is empty. Repeated rows are kept, other
    columns are not looked at, an empty frame gives none. The key is an integer.

    The texts move once: ranges of keys are dealt over the partitions and sorted there, and the first text of each
    range is also sent to the range before it. Very long texts pass through one at a time.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    parts = partitions(spark)
    kind = df.schema[key].dataType
    place = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long"))
    count = CHUNKS_PER_PARTITION * parts
    marks = [i / count for i in range(1, count)]
    found = df.agg(F.percentile_approx(place, marks, 10 * count).alias("cuts")).first()["cuts"]
    cuts = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def chunk_of(places: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, places.to_numpy(np.int64), "right"))

    rows = df.select(place.alias("place"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = df.select(place.alias("place")).withColumn("own", chunk_of("place"))
    firsts = {r["own"]: r["first"] for r in own.groupBy("own").agg(F.min("place").alias("first")).collect()}
    filled = sorted(firsts)  # as many as there are chunks at most
    before = {chunk: filled[i - 1] for i, chunk in enumerate(filled)}
    first_of = F.array(*[F.lit(firsts.get(c)).cast("long") for c in range(len(cuts) + 1)])
    sent_to = F.array(*[F.lit(before.get(c)).cast("int") for c in range(len(cuts) + 1)])

    def to(chunk, borrowed):
        return F.struct(chunk.cast("int").alias("chunk"), F.lit(borrowed).alias("borrowed"))

    rows = rows.withColumn("own", chunk_of("place"))
    also = F.when(F.col("place") == F.get(first_of, F.col("own")), F.array(to(F.get(sent_to, F.col("own")), 1))).otherwise(
        F.array().cast("array<struct<chunk:int,borrowed:int>>"))
    dealt = (
        rows.withColumn("to", F.explode(F.concat(F.array(to(F.col("own"), 0)), also)))
        .select("to.chunk", "to.borrowed", "place", "key", "text")
        .repartition(parts, "chunk").sortWithinPartitions("chunk", "borrowed", "place", "text")
    )
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for row in _with_next(batches):
            gathered.append(row)
            size += len(row[1])
            if size >= BUFFER or len(gathered) >= BUFFER_ROWS:
                yield _digest(gathered, key_type, schema.names)
                gathered, size = [], 0
        if gathered:
            yield _digest(gathered, key_type, schema.names)

    key_type = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind.simpleString()]
    return dealt.mapInArrow(read, schema)


def _matrix(prints: list[str], end: int, octaves: int) -> np.ndarray:
    """The digits of prints as rows, ``end`` past their ends."""
    out = np.full((len(prints), octaves * DIGITS), end, np.uint8)
    for row, digits in zip(out, prints):
        row[:len(digits)] = np.frombuffer(digits.encode(), np.uint8)
    return out


def likenesses(some: list[str], others: list[str]) -> np.ndarray:
    """``likeness`` of each of some prints, none empty, to each of others."""
    octaves = -(-max(map(len, [*some, *others])) // DIGITS)
    x, y = _matrix(some, 1, octaves), _matrix(others, 2, octaves)
    same, live = np.zeros((2, len(some), len(others)))
    for o in range(octaves):
        part = slice(o * DIGITS, (o + 1) * DIGITS)
        same += LENGTHS[o] * (x[:, None, part] == y[None, :, part]).sum(2)
        live += LENGTHS[o] * np.maximum((x[:, part] != 1).sum(1)[:, None], (y[:, part] != 2).sum(1)[None])
    return np.clip((same / live - 1 / 16) / (15 / 16), 0, 1)


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the smallest class that ``links`` connect each to, itself if none."""
    roots = components(links.select(F.col("name").alias("a"), F.col("near").alias("b"))).withColumnRenamed("node", "name")
    return members.join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))


def _rest(members: DataFrame, classes: DataFrame, at_least: float) -> DataFrame:
    """(name, near, likeness): links between members of a bucket that are not connected, from (name, bucket, root).

    The members outside a bucket's most frequent component are held against all, in blocks of bounded size.
    """
    sizes = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("bucket").agg(F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("main"))
    sizes = sizes.where(F.col("main.n") < F.col("all")).select(
        "bucket", F.col("main.root").alias("main"), F.floor(F.col("all") / BLOCK).cast("int").alias("far"),
        F.floor((F.col("all") - F.col("main.n")) / BLOCK).cast("int").alias("near_by"))
    rows = keep(members.join(sizes, "bucket").join(classes.select("name", "print"), "name"))

    def dealt(highest: str, own: str, other: str, to: str) -> list:
        return [F.pmod(F.xxhash64("name"), F.col(highest) + 1).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.col(other))).alias(to)]

    outside = rows.where("root <> main").select("bucket", "name", "root", "print", *dealt("near_by", "p", "far", "q"))
    whole = rows.select(F.col("bucket").alias("bucket"), F.col("name").alias("name"), F.col("root").alias("root"),
                        F.col("print").alias("print"), *dealt("far", "q", "near_by", "p"))

    def verify(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        names, near, like = [], [], []
        for low in range(0, min(len(one), len(other) and len(one)), 64):
            part = one.iloc[low:low + 64]
            score = likenesses(list(part["print"]), list(other["print"]))
            a, b = part["name"].to_numpy(), other["name"].to_numpy()
            hit = (score >= at_least) & (part["root"].to_numpy()[:, None] != other["root"].to_numpy()[None])
            i, j = np.nonzero(hit)
            names += np.maximum(a[i], b[j]).tolist()
            near += np.minimum(a[i], b[j]).tolist()
            like += score[i, j].tolist()
        return pd.DataFrame({"name": names, "near": near, "likeness": like})

    cells = ["bucket", "p", "q"]
    return outside.groupBy(*cells).cogroup(whole.groupBy(*cells)).applyInPandas(
        verify, "name long, near long, likeness double").distinct()


def near_pairs(prints: DataFrame, key: str, fingerprint: str, at_least: float = 0.8, width: int = 4) -> DataFrame:
    """(key, near, likeness): documents and a document of smaller key that their fingerprint is like.

    ``width`` digits next to each other, from the last two octaves that a fingerprint fills, are a band. The rows
    connect any two documents that are ``at_least`` alike and share a bucket of a band, though not each to each:
    equal fingerprints are one class and give a row to the smallest key, the members of a bucket are held against one
    of them, then against one that the first has left apart, and all that are still unconnected against each other.
    Rows with a null or empty fingerprint or a null key have no pair. A document may be like several others and then
    has several rows.
    """
    rows = keep(prints.select(F.col(key).alias("key"), F.col(fingerprint).alias("print")).where("key IS NOT NULL AND print <> ''").distinct())
    classes = keep(rows.groupBy("print").agg(F.min("key").alias("least")).select(F.monotonically_increasing_id().alias("name"), "least", "print"))
    top = F.floor(F.length("print") / DIGITS) - 1
    bands = classes.select("name", F.explode(F.sequence(F.greatest(top - 1, F.lit(0)), F.greatest(top, F.lit(0)))).alias("octave"), "print").select(
        "name", "octave", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(DIGITS // width - 1)),
            lambda i: F.substr("print", (F.col("octave") * DIGITS + i * width + 1).cast("int"), F.lit(width)))).alias("band", "digits"))
    members = bands.where(F.length("digits") == width).select("name", F.concat_ws(":", "octave", "band", "digits").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = keep(members.join(shared, "bucket"))

    @F.pandas_udf("double")
    def alike(one: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series(likeness(list(one), list(other)))

    def held(pairs: DataFrame) -> DataFrame:
        one = classes.select(F.col("name").alias("name"), F.col("print").alias("print"))
        other = classes.select(F.col("name").alias("near"), F.col("print").alias("near_print"))
        both = pairs.join(one, "name").join(other, "near")
        return both.select("name", "near", alike("print", "near_print").alias("likeness")).where(F.col("likeness") >= at_least)

    def pairs_of(members: DataFrame, heads: DataFrame) -> DataFrame:
        """Members and heads of their buckets that are not connected, the smaller class second."""
        both = members.join(heads, "bucket").where("root <> head_root")
        return both.select(F.greatest("name", "head").alias("name"), F.least("name", "head").alias("near")).distinct()

    def heads_of(members: DataFrame) -> DataFrame:
        return members.groupBy("bucket").agg(F.min(F.struct("name", "root")).alias("least")).select(
            "bucket", F.col("least.name").alias("head"), F.col("least.root").alias("head_root"))

    rooted = members.withColumn("root", F.col("name"))
    links = keep(held(pairs_of(rooted, heads_of(rooted))))
    rooted = keep(_labelled(members, links))
    first = heads_of(rooted).withColumnRenamed("head_root", "first_root").select("bucket", "first_root")
    apart = rooted.join(first, "bucket").where("root <> first_root").select("bucket", "name", "root")
    links = keep(links.unionByName(held(pairs_of(rooted, heads_of(apart)))))
    rooted = keep(_labelled(members, links))
    links = links.unionByName(_rest(rooted, classes, at_least)).dropDuplicates(["name", "near"])
    least = classes.select("name", "least")
    named = (
        links.join(least.select("name", F.col("least").alias("one")), "name")
        .join(least.select(F.col("name").alias("near"), F.col("least").alias("other")), "near").where("one <> other")
        .select(F.greatest("one", "other").alias("key"), F.least("one", "other").alias("near"), "likeness")
    )
    copies = rows.join(classes.select("print", "least"), "print").where("key <> least").select(
        "key", F.col("least").alias("near"), F.lit(1.0).alias("likeness"))
    return named.unionByName(copies).groupBy("key", "near").agg(F.max("likeness").alias("likeness"))


def near_groups(prints: DataFrame, key: str, fingerprint: str, at_least: float = 0.8) -> DataFrame:
    """(key, component_id) of every row: the smallest key that ``near_pairs`` connect it to, itself if none."""
    pairs = near_pairs(prints, key, fingerprint, at_least).select(F.col("key").alias("a"), F.col("near").alias("b"))
    roots = components(pairs)
    rows = prints.select(F.col(key).alias(key))
    joined = rows.join(roots, F.col(key) == F.col("node"), "left")
    return joined.select(key, F.coalesce("root", key).alias("component_id"))
