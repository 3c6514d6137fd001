"""N-gram Jaccard join by token-combination prefixes.

The tokens of a document are its distinct word shingles. Two documents are linked when their tokens' Jaccard
similarity reaches a bound; then each lacks few of the other's tokens, and the rarest tokens of both, their
prefixes, have something in common. Rare tokens are indexed one by one. Frequent tokens are dealt into classes and indexed as pairs within a class, for which the prefix is longer: it goes on until
taking away as many tokens as a linked document may lack leaves a single rare token or a pair. So a frequent token
alone never makes a candidate, and no link is lost.

Candidates are found per signature, verified exactly on the tokens, and joined to components:

1. Each signature's documents are held against its most central one (the one with most frequent tokens), which
   joins nearly all of a large group of copies at the cost of one pair a document; then those still apart are held
   against one more.
2. What shares a signature and is still in two components is compared pair by pair, after a bit-map bound on the
   number of tokens that two documents do not share. Two documents that have many signatures in common meet at one
   of them alone if a sketch of their signatures shows a common one.

Equal token sets are one class from the start; tokens and classes are 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import LongType

from tradeloom.llm.components import components
from tradeloom.llm.frames import bounded_batches, giving_back, keep, kept_table, partitions, small
from tradeloom.llm.textarrays import column_bytes, mixed, shingles, slices, words

U64 = np.uint64
CELL_BITS = 20  # of the sketch of token counts
PART = 4096  # cells of the sketch that travel together
LEVELS = 64  # of rank up to what chance puts into a cell
MORE_HEADS = 1  # rounds in which a signature's documents are held against one more of them
SALTS = 16  # by which the documents of a frequent signature are spread
MAP_WORDS = 8  # 64-bit words of a document's bit map
LEAST = 8  # buckets of signatures of which a document's least are known
TOKEN_BYTES = 6  # of a token's hash that two documents are verified by: 48 bits tell their few thousand tokens apart
FILTER_WORDS = 1 << 18  # of the 2 MB filter of documents whose tokens are needed


@dataclass(frozen=True)
class Bound:
    """Jaccard similarity of at least ``percent`` hundredths, 60 to 100; below, prefixes need not be long enough."""

    percent: int

    def __post_init__(self):
        if not 60 <= self.percent <= 100:
            raise ValueError("the bound must be 60 to 100 percent")

    def may_lack(self, n: np.ndarray | int):
        """How many of n tokens a linked document may lack."""
        return n - -(-self.percent * n // 100)

    def band(self, n: int) -> int:
        """Sizes of linked sets lie in the same band or in neighbouring ones."""
        return int(np.floor(np.log(n) / -np.log((self.percent - 1) / 100)))

    def band_size(self, band: int) -> int:
        return int(((self.percent - 1) / 100) ** -band)

    def may_link(self, n: int) -> bool:
        """Whether a set of n tokens can be linked to a larger one."""
        return 100 * n >= self.percent * (n + 1)


@dataclass
class Frequencies:
    """What is known of tokens by their hashed cell in a sketch of all counts; small, of fixed size.

    A cell holds the counts of all its tokens, so a token is no more frequent than its cell. Tokens alone in their
    documents lie in cells of about the same count, and one that many documents share stands out.
    """

    rank: np.ndarray  # by cell: its count in levels, 0 to 255
    frequent: np.ndarray  # by cell: whether its count is far beyond chance

    def cells(self, tokens: np.ndarray) -> np.ndarray:
        return (tokens >> U64(64 - CELL_BITS)).astype(np.int64)

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """Sort keys, rarest first: the rank of a token, then its hash."""
        return self.rank[self.cells(tokens)].astype(np.uint64) << U64(56) | tokens >> U64(8)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(first row, end, words) of the texts of a batch, slice by slice."""
    data, offsets = column_bytes(batch.column("text"))
    for i, j in slices(offsets):
        yield i, j, words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def fingerprint(tokens: np.ndarray) -> int:
    """A set's hash; that of the empty set is 0."""
    if not len(tokens):
        return 0
    return int(mixed(np.array([mixed(tokens).sum(dtype=np.uint64) + U64(len(tokens))], np.uint64))[0].astype(np.int64))


def describe(docs: DataFrame, width: int) -> DataFrame:
    """(key, n, class, bits, part, counts): a row for each document, and rows of each task's share of the sketch."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            sizes, prints, bits = [], [], []
            for _, _, found in _rows(batch):
                held = list(shingles(found, width))
                sizes += [len(t) for t in held]
                prints += [fingerprint(t) for t in held]
                bits += [bit_map(t) for t in held]
                flat = np.concatenate(held) if held else np.zeros(0, np.uint64)
                cells += np.bincount((flat >> U64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()),
                 pa.array(bits, pa.list_(pa.int64())), none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        if cells.any():
            parts = cells.astype("<u4").reshape(-1, PART)
            none = pa.nulls(len(parts)).cast(pa.int64())
            packed = pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.nulls(len(parts)).cast(pa.list_(pa.int64())), pa.array(range(len(parts)), pa.int32()), packed],
                names=names)

    names = ["key", "n", "class", "bits", "part", "counts"]
    return docs.mapInArrow(giving_back(read), "key long, n long, class long, bits array<long>, part int, counts binary")


def frequencies(described: DataFrame) -> Frequencies:
    """Sum the tasks' sketches, part by part in a stream; the driver gets their fixed size of 8 MB."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[part] = sums.get(part, 0) + np.frombuffer(zlib.decompress(counts), "<u4").astype("<i8")
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["part", "counts"])

    shares = described.where("part IS NOT NULL").select("part", "counts")
    summed = shares.repartition(partitions(described.sparkSession), "part").mapInArrow(total, "part int, counts binary")
    cells = np.zeros(1 << CELL_BITS)
    for row in summed.collect():
        cells[row["part"] * PART:(row["part"] + 1) * PART] = np.frombuffer(row["counts"], "<i8")
    chance = cells.mean()
    rank = np.minimum(LEVELS * cells / max(chance, 1), 255).astype(np.uint8)
    return Frequencies(rank, cells > 2 * chance + 64)


def _pairs(tokens: np.ndarray, classes: np.ndarray, band: int) -> np.ndarray:
    """A signature for each two tokens of the same class."""
    order = np.lexsort((tokens, classes))
    tokens, classes = tokens[order], classes[order]
    out = []
    for step in range(1, len(tokens)):
        same = classes[step:] == classes[:-step]
        if not same.any():
            break
        out.append(mixed(tokens[:-step][same] * U64(0x9E3779B97F4A7C15) + mixed(tokens[step:][same] + U64(band))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def signatures(keys: np.ndarray, frequent: np.ndarray, bound: Bound) -> tuple[np.ndarray, np.ndarray]:
    """(signatures of single rare tokens, of pairs of frequent ones) of a document, from its sorted keys.

    A pair's class and the length of the prefix depend on the document's size through its band; so that documents of
    neighbouring bands meet, each has the signatures of its own band and the next.
    """
    n = len(keys)
    need = int(bound.may_lack(n)) + 1
    if not frequent[:need].any():
        return keys[:need], keys[:0]
    tokens = keys << U64(8)  # the rank is left out, so a token looks alike everywhere
    rare, paired = 0, []
    band = bound.band(n)
    for tag in (band, band + 1):
        groups = U64(max(1, int(bound.may_lack(bound.band_size(tag))) // 3))
        group = (mixed(tokens) % groups).astype(np.int64)
        gain = np.ones(n, np.int64)
        seen: set[int] = set()
        for i in np.flatnonzero(frequent):
            if group[i] not in seen:  # the first of a class makes no pair yet
                seen.add(group[i])
                gain[i] = 0
        end = min(n, int(np.searchsorted(np.cumsum(gain), need)) + 1)
        rare = max(rare, end)
        inside = frequent[:end]
        paired.append(_pairs(tokens[:end][inside], group[:end][inside], tag))
    return keys[:rare][~frequent[:rare]], np.concatenate(paired)


def index(docs: DataFrame, width: int, bound: Bound, freq) -> DataFrame:
    """(sig, class, central, salt) for each signature of each document; ``freq`` is the broadcast ``Frequencies``.

    ``central`` grows with the number, and the share, of tokens in cells of twice the count that chance puts there. Documents with a pair as signature are spread by a
    salt; those of a single token are not, since a rare token's count is bounded by its cell of the sketch.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Frequencies = freq.value
        for batch in batches:
            for _, _, found in _rows(batch):
                sigs, classes, central, salts = [], [], [], []
                for tokens in shingles(found, width):
                    n = len(tokens)
                    if not n or not bound.may_link(n):
                        continue
                    keys = known.keys(tokens)
                    order = np.argsort(keys, kind="stable")
                    keys, often = keys[order], known.frequent[known.cells(tokens[order])]
                    single, paired = signatures(keys, often, bound)
                    name, size = fingerprint(tokens), len(single) + len(paired)
                    common = int(((keys >> U64(56)) >= 2 * LEVELS).sum())
                    sigs += [mixed(single), paired]
                    classes.append(np.full(size, name, np.int64))
                    central.append(np.full(size, 16 * common * common // n, np.int32))
                    salt = np.zeros(size, np.int32)
                    salt[len(single):] = 1 + name % SALTS
                    salts.append(salt)
                if classes:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(sigs).astype(np.int64)), pa.array(np.concatenate(classes)),
                         pa.array(np.concatenate(central)), pa.array(np.concatenate(salts))],
                        names=["sig", "class", "central", "salt"])

    return docs.mapInArrow(giving_back(read), "sig long, class long, central int, salt int")


def bit_map(tokens: np.ndarray) -> np.ndarray:
    """Which of 512 buckets hold an odd number of the tokens; two sets differ in at least as many tokens as bits."""
    bucket = (mixed(tokens + U64(1)) & U64(64 * MAP_WORDS - 1)).astype(np.int64)
    odd = np.bincount(bucket, minlength=64 * MAP_WORDS).astype(np.uint64) & U64(1)
    return (odd.reshape(MAP_WORDS, 64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64).view(np.int64)


def token_sets(docs: DataFrame, width: int, wanted) -> DataFrame:
    """(key, class, tokens) of the documents that the broadcast filter ``wanted`` lets through.

    Tokens are sorted and packed, TOKEN_BYTES of their hash each. A null key is 0 here. Rows that repeat within a task are
    left out.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            keys = batch.column("key").fill_null(0)
            passed = pa.array(key_passes(wanted.value, keys.to_numpy(zero_copy_only=False)))
            batch, keys = batch.filter(passed), keys.filter(passed).to_pylist()
            for i, j, found in _rows(batch):
                rows = []
                for key, tokens in zip(keys[i:j], shingles(found, width)):
                    row = (key, fingerprint(tokens), packed(tokens))
                    if row[:2] not in done:
                        done.add(row[:2])
                        rows.append(row)
                if rows:
                    columns = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))],
                        names=["key", "class", "tokens"])

    return docs.mapInArrow(giving_back(read), "key long, class long, tokens binary")


def packed(tokens: np.ndarray) -> bytes:
    """The highest TOKEN_BYTES of each sorted hash, which stay sorted."""
    return tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // TOKEN_BYTES, 8), np.uint8)
    wide[:, :TOKEN_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BYTES)
    return wide.reshape(-1).view(">u8")


@F.arrow_udf(LongType())
def shared_tokens(one: pa.Array, other: pa.Array) -> pa.Array:
    """How many tokens two packed sets share."""
    counts = []
    for a, b in zip(one, other):
        x, y = unpacked(a.as_py()), unpacked(b.as_py())
        at = np.searchsorted(y, x)
        counts.append(int((y[np.minimum(at, len(y) - 1)] == x).sum()))
    return pa.array(counts, pa.int64())


def _places(keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    hashed = mixed(keys.astype(np.int64).view(np.uint64) + U64(2))
    return [((hashed >> U64(s) & U64(FILTER_WORDS - 1)).astype(np.int64), hashed >> U64(s + 20) & U64(63)) for s in (0, 32)]


def key_passes(filled: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a filter lets through."""
    return np.logical_and.reduce([filled[word] >> bit & U64(1) > 0 for word, bit in _places(keys)])


def key_filter(keys: DataFrame) -> np.ndarray:
    """A filter of fixed size for the keys in the one column: passes all of them, and others the fuller it is."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = np.zeros(FILTER_WORDS, np.uint64)
        for batch in batches:
            for word, bit in _places(batch.column(0).to_numpy(zero_copy_only=False)):
                np.bitwise_or.at(filled, word, U64(1) << bit)
        word = np.flatnonzero(filled)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(filled[word].view(np.int64))], names=["word", "bits"])

    filled = np.zeros(FILTER_WORDS, np.uint64)
    summed = keys.mapInArrow(fill, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    filled[summed.column("word").to_numpy()] = summed.column("bits").to_numpy().view(np.uint64)
    return filled


def enough(shared: Column, n: Column, m: Column, bound: Bound) -> Column:
    return shared * 100 >= F.lit(bound.percent) * (n + m - shared)


def close_pairs(pairs: DataFrame, classes: DataFrame, bound: Bound) -> DataFrame:
    """The pairs (a, b) that their sizes and bit maps do not rule out."""
    a, b = ([F.col(c).alias(f"{side}_{c}") for c in ("class", "n", "bits")] for side in "ab")
    both = pairs.join(classes.select(*a), F.col("a") == F.col("a_class")).join(classes.select(*b), F.col("b") == F.col("b_class"))
    return both.where(not_apart(F.col("a_n"), F.col("a_bits"), F.col("b_n"), F.col("b_bits"), bound)).select("a", "b")


def verified(close: DataFrame, classes: DataFrame, docs: DataFrame, width: int, bound: Bound) -> DataFrame:
    """The pairs (a, b) of classes that are linked, by their tokens.

    Only the texts of classes in a pair are split into tokens again: a filter of fixed size on the keys leaves the
    others out, an exact join removes what it lets through too much. Of a pair, the class with more pairs is the hub:
    the other's tokens move to it, and its own move once for all its pairs.
    """
    spark = docs.sparkSession
    close = keep(close)
    degree = close.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("degree"))
    known = keep(degree.join(classes.select("class", F.coalesce("key", F.lit(0).cast("long")).alias("key")), "class"))
    a, b = (known.select(F.col("class").alias(side), F.struct("degree", "class", "key").alias(f"{side}_end")) for side in "ab")
    ends = close.join(a, "a").join(b, "b").select(
        F.greatest("a_end", "b_end").alias("hub"), F.least("a_end", "b_end").alias("member"))
    ends = keep(ends.select(F.col("hub.class").alias("hub"), F.col("hub.key").alias("hub_key"), F.col("member.class").alias("class"),
                            F.col("member.key").alias("key")))
    wanted = spark.sparkContext.broadcast(key_filter(known.select("key")))
    sent = token_sets(docs, width, wanted)
    members = sent.join(small(ends.drop("hub_key")), ["class", "key"])
    hubs = ends.select(F.col("hub").alias("class"), F.col("hub_key").alias("key")).distinct()
    hubs = sent.join(small(hubs), ["class", "key"]).select(F.col("class").alias("hub"), F.col("tokens").alias("hub_tokens")).dropDuplicates(["hub"])
    both = members.join(hubs, "hub")
    n, m = (F.floor(F.octet_length(c) / TOKEN_BYTES) for c in ("tokens", "hub_tokens"))
    linked = both.where(enough(shared_tokens("tokens", "hub_tokens"), n, m, bound))
    return linked.select(F.least("hub", "class").alias("a"), F.greatest("hub", "class").alias("b"))


def not_apart(n: Column, bits: Column, m: Column, other: Column, bound: Bound) -> Column:
    """Whether sizes and bit maps leave it possible that two sets are linked."""
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.get(bits, F.lit(i)).bitwiseXOR(F.get(other, F.lit(i)))) for i in range(MAP_WORDS)])
    sizes = (F.least(n, m) * 100 >= F.greatest(n, m) * bound.percent)
    return sizes & enough((n + m - apart) / 2, n, m, bound)


def linked_classes(docs: DataFrame, described: DataFrame, width: int, bound: Bound) -> DataFrame:
    """(node, root): the components of the classes that are linked to another class."""
    spark = docs.sparkSession
    freq = spark.sparkContext.broadcast(frequencies(described))  # about 2 MB
    entries = index(docs, width, bound, freq)

    bucket = Window.partitionBy("sig", "salt").orderBy(F.desc("central"), "class")
    whole = bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entries = entries.select(
        "sig", "salt", "class", "central", F.first("class").over(bucket).alias("head"),
        F.coalesce(F.lag("class").over(bucket) != F.col("class"), F.lit(True)).alias("fresh"),
        (F.min("class").over(whole) != F.max("class").over(whole)).alias("crowded"))
    # A salted document alone under its salt may still share the signature under another.
    met = kept_table(entries.where("fresh AND (crowded OR salt > 0)").drop("fresh", "crowded"))
    heads = met.where("salt > 0").groupBy("sig").agg(
        F.max(F.struct("central", "head")).alias("top"), F.min("class").alias("low"), F.max("class").alias("high"))
    heads = heads.where("low <> high").select("sig", F.col("top.head").alias("top"))
    first = met.where("class <> head").select(F.col("head").alias("a"), F.col("class").alias("b"))
    across = met.where("salt > 0").join(heads, "sig").select(F.col("top").alias("a"), F.col("head").alias("b")).where("a <> b")
    pairs = keep(first.union(across).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    classes = keep(described.where("n > 0").groupBy("class").agg(
        F.min("key").alias("key"), F.min("n").alias("n"), F.any_value("bits").alias("bits")))
    roots = keep(components(verified(close_pairs(pairs, classes, bound), classes, docs, width, bound)))

    # The head of a signature without salts was held against all others already.
    rest = met.where("class <> head OR salt > 0").select("sig", "class", "central")
    for _ in range(MORE_HEADS):
        again = Window.partitionBy("sig").orderBy(F.desc("central"), "class")
        rest = kept_table(still_apart(rest, roots).withColumns({
            "head": F.first("class").over(again), "head_root": F.first("root").over(again)}))
        tried = rest.where("root <> head_root").select(F.least("head", "class").alias("a"), F.greatest("head", "class").alias("b"))
        tried = keep(tried.distinct().join(pairs, ["a", "b"], "left_anti"))
        roots = keep(components(roots.union(verified(close_pairs(tried, classes, bound), classes, docs, width, bound)).toDF("a", "b")))
        pairs = pairs.union(tried)
        rest = rest.where("class <> head").select("sig", "class", "central")

    more = meetings(kept_table(still_apart(rest, roots).drop("central")), classes, bound)
    more = more.distinct().join(pairs, ["a", "b"], "left_anti")
    return components(roots.union(verified(more, classes, docs, width, bound)).toDF("a", "b"))


def meetings(rest: DataFrame, classes: DataFrame, bound: Bound) -> DataFrame:
    """(a, b): classes of different roots that share a signature of ``rest`` (sig, class, root) and may be linked.

    A pair comes at each of its common signatures only if the least signatures of both, bucket by bucket, are all
    different; else at the first that are equal, where both have a row.
    """
    bucket = F.pmod("sig", F.lit(LEAST))
    least = rest.groupBy("class").agg(F.array(*[F.min(F.when(bucket == i, F.col("sig"))) for i in range(LEAST)]).alias("least"))
    known = keep(least.join(classes.select("class", "n", "bits"), "class"))
    rest = kept_table(rest.join(small(known), "class"))
    left, right = (rest.select("sig", *[F.col(c).alias(f"{side}_{c}") for c in ("class", "root", "n", "bits", "least")]) for side in "ab")
    may = not_apart(F.col("a_n"), F.col("a_bits"), F.col("b_n"), F.col("b_bits"), bound)
    one, other = ([F.get(f"{side}_least", F.lit(i)) for i in range(LEAST)] for side in "ab")
    place = F.coalesce(*[F.when(x == y, x) for x, y in zip(one, other)], left["sig"])
    both = left.join(right, (left["sig"] == right["sig"]) & (F.col("a_class") < F.col("b_class")) & (F.col("a_root") != F.col("b_root"))
                     & may & (place == left["sig"]))
    return both.select(F.col("a_class").alias("a"), F.col("b_class").alias("b"))


def still_apart(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (sig, class, ...) with the root of their class, of the signatures that are still in several components."""
    placed = rows.join(small(roots).withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    by_sig = Window.partitionBy("sig")
    apart = placed.withColumns({"low": F.min("root").over(by_sig), "high": F.max("root").over(by_sig)}).where("low <> high")
    return apart.drop("low", "high")


def join_groups(df: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``df``.

    Words are split by white space and lower-cased in A to Z; a text's set has its distinct runs of ``width`` words, or
    its whole sequence if it has fewer. Rows are linked when 100 times the intersection is at least ``percent`` times
    the union; component_id is the smallest key that links lead to. A null or empty text, or one of white space, has
    no shingle, is linked with nothing and is its own component. Rows with a null key are linked like others but
    lend no id: a component of only such rows has a null id. Repeated rows are kept and share a component.
    An empty frame gives none. Other columns are not looked at.
    """
    bounded_batches(df.sparkSession)
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    bound = Bound(percent)
    described = keep(describe(docs, width))
    roots = linked_classes(docs, described, width, bound)
    rows = described.where("n IS NOT NULL").select("key", "n", "class")
    placed = keep(
        rows.where("n > 0").join(roots.withColumnRenamed("node", "class"), "class", "left")
        .select("key", "n", F.coalesce("root", "class").alias("root"))
    )
    least = placed.groupBy("root").agg(F.min("key").alias("component_id"))
    grouped = placed.join(least, "root").select("key", "n", "component_id")
    alone = rows.where("n = 0").select("key", "n", F.col("key").alias("component_id"))
    return grouped.union(alone).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")
