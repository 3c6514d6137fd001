"""Alignment of the tokens of two tokenizers by diagonal run skipping.

Both tokenizers cut the same bytes, so where a token of each ends tells all: byte offsets at which both end cut the tokens
into groups. Most groups are one token of each, in stretches. There the two arrays of ends agree at a fixed shift of their
indices, so slices of doubling length are compared at that shift, and a stretch is jumped over in steps as many as its
length's logarithm. Where the ends part, the irregular group is closed by advancing the side that lags, and the shift
follows. A token of each side is a link where their bytes overlap: within a group of p and q tokens there are p + q - 1.

How often each pair of ids is linked in the whole corpus is summed in the tasks, then by pair; documents are then read
against these counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.frames import bounded_batches, fresh_name, keep, kept_table
from tradeloom.llm.packing import Encoder, encoder, runs
from tradeloom.llm.textarrays import cut_out
from tradeloom.operators.skew import join_group_stats

PIECE_SPACE = "▁"  # a fixed value of piece vocabularies: how they write a space
BYTE_PIECE = "<0x%02X>"  # a fixed value: how they write a single byte
BROADCAST_PAIRS = 3_000_000  # of ids, 16 bytes each; beyond, documents and counts are joined
HELD_PAIRS = 500_000  # of a task, before they are sent on
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_letters() -> dict[str, int]:
    """The bytes that the letters of a byte-level vocabulary stand for: printable ones for themselves, the others for
    the letters from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """The bytes of every token, one after the other."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        ends = np.cumsum([len(t) for t in tokens])
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.append(0, ends[:-1]), ends)

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.ends[ids] - self.starts[ids]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return cut_out(self.data, self.starts[ids], self.ends[ids])


class PieceEncoder(Encoder):
    """The same for a sentence-piece model that puts a space before each text: as no piece goes on after a space within it,
    a text is the sum of its words here too."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_file=path)
        self.names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.opens = np.array([n.startswith(PIECE_SPACE) for n in self.names], bool)
        self.by_word = not any(PIECE_SPACE in n.lstrip(PIECE_SPACE) for n in self.names)
        self.forget()

    def odd(self, text: str) -> bool:
        return not self.by_word or PIECE_SPACE in text or super().odd(text)

    def together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of texts that begin with a space: the model adds it."""
        held = [np.array(x, "<u4") for x in self.pieces.encode([t[1:] for t in texts], num_threads=1)]
        return np.concatenate([np.zeros(0, "<u4"), *held]), np.array([len(h) for h in held], np.int64)


class TwoTokenizers:
    """A byte-level BPE (A) and a sentence-piece model (B) over a space and the text."""

    def __init__(self, bpe: str, pieces: str):
        self.encoder, self.pieces = encoder(bpe), PieceEncoder(pieces)
        names = self.encoder.tokenizer.get_vocab()
        letters, tokens = byte_letters(), [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            tokens[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.a = Vocabulary.of(tokens)
        single = {BYTE_PIECE % b: bytes([b]) for b in range(256)}
        self.b = Vocabulary.of([single.get(p) or p.replace(PIECE_SPACE, " ").encode() for p in self.pieces.names])
        most = max(len(self.a.ends), len(self.b.ends))
        self.width = len(str(most - 1)) + 1
        self.digits = np.zeros((most, self.width), np.uint8)
        for i in range(most):
            self.digits[i, :len(str(i))] = list(str(i).encode())
        self.digit_counts = (self.digits > 0).sum(1)
        self.wide = most > 1 << 16

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None]:
        """The ids of each text by both and where their bytes end; None where there is no text or the tokens' bytes are not
        the text's."""
        sides = []
        wanted = [b" " + t.encode() for t in texts]
        for encode, known in ((self.encoder, self.a), (self.pieces, self.b)):
            ids, counts = encode.encode_all(texts, spaced=True)
            sides.append((known, ids.astype(np.int64), np.append(0, np.cumsum(counts)).tolist()))
        for i, text in enumerate(wanted):
            out = []
            for known, ids, bounds in sides:
                own = ids[bounds[i]:bounds[i + 1]]
                if len(text) > 1 and known.joined(own).tobytes() == text:
                    out += [own, np.cumsum(known.sizes(own))]
            yield (out[0], out[2], out[1], out[3]) if len(out) == 4 else None

    def group_text(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: ids of A and B of each group."""
        groups_a, groups_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        place_a = np.arange(len(a)) + np.repeat(cut_b - groups_b, groups_a)
        place_b = np.arange(len(b)) + np.repeat(cut_a, groups_b)
        ids, after = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        after[place_a[cut_a - 1]], after[place_b[cut_b - 1]] = ord("|"), ord(";")
        shown, length = self.digits[ids], self.digit_counts[ids]
        shown[np.arange(len(ids)), length] = after
        return shown[np.arange(self.width) <= length[:, None]].tobytes()[:-1]


@lru_cache(maxsize=2)
def tokenizers(bpe: str, pieces: str) -> TwoTokenizers:
    return TwoTokenizers(bpe, pieces)


def groups(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups end, as numbers of tokens of each side, from the ends of the tokens of both.

    Ends rise, and the last ones are equal.
    """
    i, n, shift = 0, len(a), 0
    last_a, last_b, lengths = [], [], []  # of stretches, the irregular groups being stretches of one
    while i < n:
        j, start = i + shift, i
        if a[i] == b[j]:
            i, j, step = i + 1, j + 1, 2
            while i < n and a[i:i + step] == b[j:j + step]:  # ever longer slices at one shift
                i, j, step = i + step, j + step, 2 * step
            if i >= n:
                i, j = n, len(b)
            while step > 2 and i < n:  # back to the end of the stretch by halves
                step //= 2
                if a[i:i + step] == b[j:j + step]:
                    i, j = i + step, j + step
            if i < n and a[i] == b[j]:
                i, j = i + 1, j + 1
            last_a.append(i)
            last_b.append(j)
            lengths.append(i - start)
        if i < n:
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i, j = i + 1, j + 1
            last_a.append(i)
            last_b.append(j)
            lengths.append(1)
        shift = j - i
    size = np.array(lengths, np.int64)
    back = np.repeat(np.cumsum(size), size) - 1 - np.arange(size.sum())  # groups to the end of the stretch
    return np.repeat(np.array(last_a, np.int64), size) - back, np.repeat(np.array(last_b, np.int64), size) - back


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens (A, B) of every link: one for each stretch of bytes in which no token of either side ends."""
    both = np.concatenate([ends_a, ends_b])
    both.sort(kind="stable")  # two sorted runs, so a merge
    ends = both[np.append(both[1:] != both[:-1], True)]
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def _pair_type(wide: bool) -> str:
    return "<u8" if wide else "<u4"


def align(df: DataFrame, key: str, text: str, bpe: str, pieces: str) -> DataFrame:
    """(key, row, n_a, n_b, n_groups, n_links, groups, links) of every row: ``row`` is unique, ``groups`` the ids of each
    group as text, ``links`` the linked pairs of ids packed, A in the upper half."""
    bounded_batches(df.sparkSession)
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField("key", key_type), *[T.StructField(c, T.LongType()) for c in COUNTS],
                           T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = tokenizers(bpe, pieces)
        kind, half = _pair_type(two.wide), np.uint64(32 if two.wide else 16)
        for keys, texts, key_kind in runs(batches):
            rows = []
            for ids in two.encode(texts):
                if ids is None:
                    rows.append((0, 0, 0, 0, "", b""))
                    continue
                a, b, ends_a, ends_b = ids
                cut_a, cut_b = groups(ends_a.tolist(), ends_b.tolist())
                at_a, at_b = links(ends_a, ends_b)
                pairs = a[at_a].astype(np.uint64) << half | b[at_b].astype(np.uint64)
                digest = hashlib.sha256(two.group_text(a, b, cut_a, cut_b)).hexdigest()
                rows.append((len(a), len(b), len(cut_a), len(pairs), digest, pairs.astype(kind).tobytes()))
            columns = zip(zip(*rows), [pa.int64()] * 4 + [pa.string(), pa.binary()])
            yield pa.RecordBatch.from_arrays([pa.array(keys, key_kind), *[pa.array(c, t) for c, t in columns]], names=schema.names)

    return df.select(F.col(key).alias("key"), F.col(text)).mapInArrow(run, schema)


def _summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, np.int64)
    return pairs[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The packed pairs of a column of bytes, and where those of each row begin."""
    held = [np.frombuffer(x.as_buffer(), kind) if x.is_valid and x.as_buffer().size else np.zeros(0, kind) for x in column]
    return np.concatenate(held).astype(np.int64), np.append(0, np.cumsum([len(h) for h in held]))


def pair_counts(aligned: DataFrame, kind: str, b_bits: int) -> DataFrame:
    """(pair, n, best): how many links hold each pair of ids, and whether no pair of the same B id has more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new = _flat(batch.column(0), kind)[0]
            pairs, counts = _summed(np.concatenate([pairs, new]), np.concatenate([counts, np.ones(len(new), np.int64)]))
            if len(pairs) >= HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])
                pairs, counts = pairs[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    n = keep(aligned.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    b = F.col("pair").bitwiseAND((1 << b_bits) - 1)
    most = n.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return keep(n.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _by_lookup(aligned: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    """``aligned`` with n_best and count_sum, from counts that every task has."""
    held = counts.toArrow()
    pairs = held.column("pair").to_numpy()
    order = np.argsort(pairs)
    shared = aligned.sparkSession.sparkContext.broadcast(
        (pairs[order], held.column("n").to_numpy()[order], held.column("best").to_numpy()[order]))
    schema = T.StructType([f for f in aligned.schema.fields if f.name != "links"] + [
        T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for batch in batches:
            own, starts = _flat(batch.column("links"), kind)
            distinct, inverse = np.unique(own, return_inverse=True)
            at = np.searchsorted(pairs, distinct)
            sums = [np.append(0, np.cumsum(x[at][inverse].astype(np.int64)))[starts] for x in (best, n)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in schema.fields[:-2]], *[pa.array(np.diff(s)) for s in sums]], names=schema.names)

    return aligned.mapInArrow(run, schema)


def _by_join(aligned: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    """The same by a join of the pairs of documents with the counts, frequent pairs spread over tasks."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                pairs, times = np.unique(_flat(pa.array([packed]), kind)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), row)), pa.array(pairs), pa.array(times.astype(np.int64))], names=["row", "pair", "times"])

    numbered = kept_table(aligned.withColumn("row", F.monotonically_increasing_id()))
    own = numbered.where("n_links > 0").select("row", "links").mapInArrow(spread, "row long, pair long, times long")
    sums = join_group_stats(own, counts, ["pair"], "n").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    none = F.lit(0).cast("long")
    return numbered.drop("links").join(sums, "row", "left").drop("row").withColumns(
        {c: F.coalesce(c, none) for c in ("n_best", "count_sum")})


def align_corpus(df: DataFrame, key: str, text: str, bpe: str, pieces: str) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``df``.

    ``bpe`` and ``pieces`` are the files of the tokenizers; A reads a space and the text, B adds the space itself.
    n_best counts the links whose pair of ids is linked as often as any pair of the same B id in all rows, count_sum adds
    up how often. A null or empty text, and one whose tokens of either side do not give back its bytes (B writes some
    characters anew), has no tokens: zeros and an empty digest. Rows that repeat count each, a null key is kept, an empty
    frame gives none, other columns are not carried on.

    The pairs are bounded by the vocabularies. Up to BROADCAST_PAIRS of them go to every task; more are joined with the
    pairs of the documents, frequent ones spread.
    """
    two = tokenizers(bpe, pieces)
    kind, half = _pair_type(two.wide), 32 if two.wide else 16
    aligned = kept_table(align(df, key, text, bpe, pieces))
    counts = pair_counts(aligned, kind, half)
    answer = _by_lookup if counts.count() <= BROADCAST_PAIRS else _by_join
    done = answer(aligned, counts, kind)
    out = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return done.select(F.col("key").alias(key), *[F.col(c).alias(fresh_name(df.select(key), c)) for c in out])
