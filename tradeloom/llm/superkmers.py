"""Removal of repeated word windows by super-k-mer partitioning.

A window is WINDOW words in a row. Its minimiser is the least hash of its runs of GRAM words, and consecutive windows
mostly share it: they make a super-k-mer, which travels as one packed string, its words joined by spaces, to the bucket
of the minimiser. Equal windows have equal minimisers, so a bucket has all copies of its windows and sorting them there
tells the least document of each.

What moves is kept in proportion to the texts:

1. A first pass counts super-k-mers by cells of the minimiser, CELLS for what a bucket should hold. Cells that hold far
   more than their share, such as that of a line in a third of all documents, are hot: their windows travel one by one to the
   bucket of their own hash.
2. Copies of a super-k-mer within a run of texts are sent once, by the least document; that the others lose it is known
   there and then.
3. Buckets answer with the super-k-mers that lose a window, a bit for each; a document finds them again by their hashes.

Windows are told apart by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.frames import bounded_batches, fresh_name, keep, partitions
from tradeloom.llm.textarrays import SAME, SLICE, Words, column_bytes, cut_out, mixed, run_hashes, slices, words

U64 = np.uint64
WINDOW = 13
GRAM = 2
MOST_WINDOWS = 32  # of a super-k-mer: as many as its answer has bits
BUCKET_BYTES = 24 << 20  # of packed strings in a bucket, in the mean
GROWTH = 3  # bytes of packed strings for one of text, about
CELLS = 64  # of a bucket
HOT = 8  # times the mean cell
HOT_LEAST = 4096  # super-k-mers that a cell may always hold
HOT_CELLS = 1_000_000  # at most, 8 MB: the others then hold less than a millionth of all
HELD_CELLS = 200_000  # of a task, before they are sent on
FLUSH_BYTES = 4 << 20  # of text packed together
CODEC = pa.Codec("zstd", 1)


@dataclass
class Pieces:
    """Super-k-mers of some rows: the row, first word and number of windows of each, its hash and its minimiser."""

    row: np.ndarray
    word: np.ndarray
    size: np.ndarray
    hashes: np.ndarray
    minimiser: np.ndarray


def window_hashes(h: np.ndarray, window: int) -> np.ndarray:
    """Hashes of each ``window`` words in a row, over the bounds of rows too."""
    return run_hashes(h, window)


def sum_hashes(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each run of windows: windows that overlap fix their order, so the sum tells runs apart."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes, out=sums[1:])
    return mixed(sums[starts + sizes] - sums[starts] + sizes.astype(np.uint64))


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, by doubling."""
    span, out = 1, h
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(h) - width + 1], out[width - span:])


def super_kmers(found: Words, window: int = WINDOW, gram: int = GRAM) -> Pieces:
    """The super-k-mers of rows, in order. Rows of fewer than ``window`` words have none."""
    total = len(found.hashes) - window + 1
    counts = np.maximum(np.diff(found.bounds) - window + 1, 0)
    if total <= 0 or not counts.any():
        none = np.zeros(0, np.int64)
        return Pieces(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    hashes = window_hashes(found.hashes, window)
    minimiser = least_of(run_hashes(found.hashes, gram), window - gram + 1)
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.repeat(found.bounds[:-1] - np.cumsum(counts) + counts, counts) + np.arange(len(row))  # first word of each window
    change = np.ones(len(row), bool)
    change[1:] = (row[1:] != row[:-1]) | (minimiser[at[1:]] != minimiser[at[:-1]])
    run = np.flatnonzero(change)
    lengths = np.diff(np.append(run, len(row)))
    chunks = -(-lengths // MOST_WINDOWS)  # a long run, as in a text of one word, is cut
    first = np.repeat(run, chunks) + MOST_WINDOWS * (np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks))
    size = np.minimum(np.repeat(run + lengths, chunks) - first, MOST_WINDOWS)
    return Pieces(row[first], at[first], size, sum_hashes(hashes, at[first], size), minimiser[at[first]])


def single_windows(pieces: Pieces, which: np.ndarray, found: Words, window: int = WINDOW) -> Pieces:
    """The windows of the chosen super-k-mers, each a piece of its own with its own hash as minimiser."""
    sizes = pieces.size[which]
    word = np.repeat(pieces.word[which] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    hashes = window_hashes(found.hashes, window)
    one = np.ones(len(word), np.int64)
    return Pieces(np.repeat(pieces.row[which], sizes), word, one, sum_hashes(hashes, word, one), mixed(hashes[word]))


def _joined(*parts: Pieces) -> Pieces:
    return Pieces(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("row", "word", "size", "hashes", "minimiser")))


def cell_of(minimiser: np.ndarray, cells: int) -> np.ndarray:
    return ((minimiser >> U64(20)) % U64(cells)).astype(np.int64)


def all_pieces(found: Words, cells: int, hot: np.ndarray, window: int = WINDOW) -> Pieces:
    """Super-k-mers, those of hot cells (sorted) as single windows."""
    pieces = super_kmers(found, window)
    if not len(hot) or not len(pieces.row):
        return pieces
    cell = cell_of(pieces.minimiser, cells)
    is_hot = hot[np.minimum(np.searchsorted(hot, cell), len(hot) - 1)] == cell
    if not is_hot.any():
        return pieces
    rest = Pieces(*(getattr(pieces, f)[~is_hot] for f in ("row", "word", "size", "hashes", "minimiser")))
    return _joined(rest, single_windows(pieces, is_hot, found, window))


def joined_words(data: np.ndarray, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words of all rows with one space after each, and where each begins; the last entry is the end."""
    lengths = found.ends - found.starts
    begins = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths + 1, out=begins[1:])
    out = np.full(begins[-1], 32, np.uint8)
    space = np.zeros(len(out), bool)
    space[begins[1:] - 1] = True
    out[~space] = cut_out(data, found.starts, found.ends)
    return out, begins


def _least_copies(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces: those to send (the least document of each hash, once), and those that a lesser document has."""
    order = np.lexsort((docs, hashes))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    least = docs[order][new][np.cumsum(new) - 1] if len(order) else docs
    pair = new.copy()
    pair[1:] |= docs[order[1:]] != docs[order[:-1]]
    return np.sort(order[new]), np.sort(order[pair & ~new & (docs[order] > least)])


def _payload(docs: np.ndarray, sizes: np.ndarray, text: np.ndarray, lost_docs: np.ndarray, lost: np.ndarray) -> bytes:
    head = np.array([len(docs), len(text), len(lost)], "<i8")
    plain = b"".join(x.tobytes() for x in (head, docs.astype("<i8"), sizes.astype("<i4"), lost_docs.astype("<i8"), lost.astype("<u8"), text))
    return np.array([len(plain)], "<i8").tobytes() + CODEC.compress(plain, asbytes=True)


def _opened(payload: bytes) -> tuple[np.ndarray, ...]:
    size = int(np.frombuffer(payload[:8], "<i8")[0])
    plain = CODEC.decompress(payload[8:], size, asbytes=True)
    n, text, lost = np.frombuffer(plain, "<i8", 3).tolist()
    at, out = 24, []
    for kind, count in (("<i8", n), ("<i4", n), ("<i8", lost), ("<u8", lost), ("u1", text)):
        out.append(np.frombuffer(plain, kind, count, at))
        at += count * np.dtype(kind).itemsize
    return tuple(out)


def count_cells(docs: DataFrame, cells: int, window: int) -> DataFrame:
    """(cell, n): super-k-mers of each cell, those that repeat within a run of texts once."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for i, j in slices(offsets):
                pieces = super_kmers(words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], letters=SAME), window)
                _, first = np.unique(pieces.hashes, return_index=True)
                cell = cell_of(pieces.minimiser[first], cells)
                held, at = np.unique(np.concatenate([held, cell]), return_inverse=True)
                sums = np.bincount(at, np.concatenate([sums, np.ones(len(cell), np.int64)]), len(held)).astype(np.int64)
            if len(held) >= HELD_CELLS:
                yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums)], names=["cell", "n"])
                held, sums = held[:0], sums[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums)], names=["cell", "n"])

    return docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def hot_cells(docs: DataFrame, cells: int, window: int) -> np.ndarray:
    """The cells with far more than their share, the HOT_CELLS fullest at most, sorted."""
    counts = keep(count_cells(docs, cells, window))
    limit = max(HOT * (counts.agg(F.sum("n")).first()[0] or 0) // cells, HOT_LEAST)
    found = counts.where(F.col("n") > limit).orderBy(F.desc("n"), "cell").limit(HOT_CELLS).select("cell").toArrow()
    return np.sort(found.column("cell").to_numpy())


def deal(docs: DataFrame, buckets: int, cells: int, hot, window: int) -> DataFrame:
    """(bucket, payload): packed super-k-mers of runs of texts, by bucket; ``hot`` is broadcast."""
    def packed(data: np.ndarray, found: Words, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        pieces = all_pieces(found, cells, hot.value, window)
        if not len(pieces.row):
            return
        owner = keys[pieces.row]
        sent, lost = _least_copies(pieces.hashes, owner)
        text, begins = joined_words(data, found)
        start = begins[pieces.word]
        end = begins[pieces.word + pieces.size + window - 1] - 1
        bucket = (pieces.minimiser % U64(buckets)).astype(np.int64)
        sent, lost = (w[np.argsort(bucket[w], kind="stable")] for w in (sent, lost))
        names = np.unique(np.concatenate([bucket[sent], bucket[lost]]))
        cuts = [np.append(np.searchsorted(bucket[w], names), len(w)) for w in (sent, lost)]
        rows = []
        for k in range(len(names)):
            s, t = sent[cuts[0][k]:cuts[0][k + 1]], lost[cuts[1][k]:cuts[1][k + 1]]
            rows.append(_payload(owner[s], end[s] - start[s], cut_out(text, start[s], end[s]), owner[t], pieces.hashes[t]))
        yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(rows, pa.binary())], names=["bucket", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            data, offsets = column_bytes(batch.column("text"))
            for i, j in slices(offsets, FLUSH_BYTES):
                part = data[offsets[i]:offsets[j]]
                yield from packed(part, words(part, offsets[i:j + 1] - offsets[i], letters=SAME), keys[i:j])

    return docs.mapInArrow(run, "bucket int, payload binary")


def lost_windows(payloads: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents, hashes of super-k-mers, bits of the windows lost) of a bucket; all bits are -1."""
    docs, sizes, lost_docs, lost, text = (np.concatenate(x) for x in zip(*map(_opened, payloads)))
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    found = words(text, offsets, letters=SAME)
    counts = np.diff(found.bounds) - window + 1
    first, second = window_hashes(found.hashes, window), window_hashes(mixed(found.hashes + U64(1)), window)
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = found.bounds[:-1][row] + place
    a, b, owner = first[at], second[at], docs[row]
    order = np.argsort(a, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = a[order[1:]] != a[order[:-1]]
    if (~new[1:] & (b[order[1:]] != b[order[:-1]])).any():  # two windows of one hash
        order = np.lexsort((b, a))
        new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    gone = np.zeros(len(order), bool)
    if len(order):
        least = np.minimum.reduceat(owner[order], np.flatnonzero(new))
        gone[order] = owner[order] > least[np.cumsum(new) - 1]
    bits = np.zeros(len(counts), np.int64)
    np.bitwise_or.at(bits, row[gone], np.int64(1) << place[gone])
    hit = bits != 0
    hashes = sum_hashes(first, found.bounds[:-1], counts)
    return (np.concatenate([docs[hit], lost_docs]), np.concatenate([hashes[hit], lost]),
            np.concatenate([bits[hit], np.full(len(lost), -1, np.int64)]))


def answers(dealt: DataFrame, buckets: int, window: int) -> DataFrame:
    """(key, piece, bits): of each document, the super-k-mers that lose windows, bucket by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(held: list[bytes]) -> pa.RecordBatch:
            docs, hashes, bits = lost_windows(held, window)
            return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(hashes.view(np.int64)), pa.array(bits)], names=["key", "piece", "bits"])

        at, held = None, []
        for batch in batches:
            for bucket, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != at and held:
                    yield answer(held)
                    held = []
                at = bucket
                held.append(payload.as_py())
        if held:
            yield answer(held)

    parts = min(buckets, 4 * partitions(dealt.sparkSession))
    by_bucket = dealt.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
    return by_bucket.mapInArrow(run, "key long, piece long, bits long")


def removed_words(pieces: Pieces, found: Words, own: list[dict[int, int] | None], window: int) -> np.ndarray:
    """Which words a lost window covers; ``own`` has for each row its lost pieces and their bits."""
    change = np.zeros(len(found.hashes) + 1, np.int64)
    for row, word, size, piece in zip(pieces.row.tolist(), pieces.word.tolist(), pieces.size.tolist(), pieces.hashes.view(np.int64).tolist()):
        bits = own[row].get(piece, 0) if own[row] else 0
        if bits:
            for k in range(size):
                if bits >> k & 1:
                    change[word + k] += 1
                    change[word + k + window] -= 1
    return np.cumsum(change[:-1]) > 0


def drop_repeats(df: DataFrame, key: str, text: str, window: int = WINDOW) -> DataFrame:
    """(key, kept, n_words, n_removed) for every row of ``df``: the words that are left, joined by one space.

    Words are runs of characters other than space and the controls 9 to 13, unchanged. A word goes if a window of
    ``window`` words covers it whose words also start in a row of smaller key; windows are those of the input. A null or
    empty text has no words and keeps an empty text; so does a text that loses all. Rows with a null key are neither
    smaller nor larger than others: they lose nothing and take nothing away. Rows of one key take nothing from each
    other and are all kept, as are columns' rows that repeat. An empty frame gives none, other columns are not carried
    on. ``key`` is an integer.
    """
    if not GRAM <= window <= 64:
        raise ValueError(f"the window must be {GRAM} to 64 words")
    spark = df.sparkSession
    bounded_batches(spark)
    docs = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    known = docs.where("key IS NOT NULL")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = -(-GROWTH * size // BUCKET_BYTES)
    buckets, cells = max(partitions(spark), wanted), CELLS * max(wanted, 1)
    hot = spark.sparkContext.broadcast(hot_cells(known, cells, window))
    lost = answers(deal(known, buckets, cells, hot, window), buckets, window)
    lost = lost.groupBy("key").agg(F.collect_list(F.struct("piece", "bits")).alias("lost"))
    with_lost = known.join(lost, "key", "left").unionByName(
        docs.where("key IS NULL").withColumn("lost", F.lit(None).cast(lost.schema["lost"].dataType)))
    names = [key] + [fresh_name(df.select(key), n) for n in ("kept", "n_words", "n_removed")]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, (T.LongType(), T.StringType(), T.LongType(), T.LongType()))])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for i, j in slices(offsets, SLICE):
                part = data[offsets[i]:offsets[j]]
                found = words(part, offsets[i:j + 1] - offsets[i], letters=SAME)
                own = [{x["piece"]: x["bits"] for x in listed} if listed else None for listed in batch.column("lost")[i:j].to_pylist()]
                gone = np.zeros(len(found.hashes), bool)
                if any(own):
                    gone = removed_words(all_pieces(found, cells, hot.value, window), found, own, window)
                joined, begins = joined_words(part, found)
                stay = np.repeat(~gone, np.diff(begins))
                kept = joined[stay].tobytes()
                ends = np.concatenate([[0], np.cumsum(stay)])[begins[found.bounds]]
                kept = [kept[a:max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                total = np.concatenate([[0], np.cumsum(gone)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key")[i:j], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(np.diff(found.bounds)),
                     pa.array(np.diff(total[found.bounds]).astype(np.int64))], names=names)

    return with_lost.select("key", "text", "lost").mapInArrow(finish, schema)
