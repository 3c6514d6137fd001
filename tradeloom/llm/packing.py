"""Packing by power-of-two decomposition.

The token ids of a document, with the separator at their end, are cut into pieces whose lengths are powers of
two: full windows first, then the binary digits of the rest from the highest. Every piece is a sequence of its
own, in the bucket of its length, so no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.frames import bounded_batches, giving_back
from tradeloom.llm.textarrays import SAME, byte_table, cut_out, words

SEPARATOR = 0
TEXTS_TOGETHER = 1 << 20  # characters of texts encoded together, unless one is longer
FLUSH_PIECES = 2_000  # that leave a task together, 8 MB at most
WORDS_TOGETHER = 200
REMEMBERED_WORDS = 500_000  # about 25 MB of words of 10 letters
SPACE = "\u0120"  # a fixed value of byte-level vocabularies: how they write a space
#: sequence_id holds the bucket, the task and the number in the task, in so many bits from the right.
TASK_BITS, NUMBER_BITS = 24, 34

#: White space other than space and line feed, which may join a space in one token.
RARE_SPACE = re.compile(r"[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
NOT_BLANK = ~byte_table(b" ")


class Encoder:
    """Encodes texts with a byte-level BPE of the ``tokenizers`` library, each word once while it is remembered.

    Such a tokenizer never joins what stands on both sides of a single space, so a text is the sum of its words. Words of
    a run of texts are told apart by their hashes, all at once, and checked byte by byte; the new ones are encoded together.
    What is remembered are arrays: sorted hashes, and where a word and its ids lie in one buffer each. Texts with other
    spaces than single ones between words are encoded whole. Texts that look like special tokens are text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Tasks run side by side already; threads of the library would each hold memory besides.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # whether a token begins with a space
        self.opens[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.places = np.zeros((4, 0), np.int32)  # of each word: begin and end of its bytes, begin and end of its ids
        self.letters, self.ids = np.zeros(0, np.uint8), np.zeros(0, "<u4")

    def odd(self, text: str) -> bool:
        """Whether a text is not the sum of its words: for other spaces than single ones between words."""
        return (not text or "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
                or RARE_SPACE.search(text) is not None)

    def together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, each encoded whole, one after the other, and how many each has."""
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        held = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, "<u4"), *held]), np.array([len(h) for h in held], np.int64)

    def after_space(self, spaced: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that stand in ``spaced`` with a space before each, at ``starts``."""
        cuts = np.append(starts, len(spaced))
        groups = [(i, min(i + WORDS_TOGETHER, len(starts))) for i in range(0, len(starts), WORDS_TOGETHER)]
        text = spaced.tobytes()
        flat, counts = self.together([text[cuts[i]:cuts[j]].decode() for i, j in groups])
        ends = np.cumsum(counts)
        out, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for (i, j), low, high in zip(groups, (ends - counts).tolist(), ends.tolist()):
            ids = flat[low:high]
            opening = np.flatnonzero(self.opens[ids])
            if len(opening) == j - i:
                size = np.diff(np.append(opening, len(ids)))
            else:
                ids, size = self.together([text[cuts[k]:cuts[k + 1]].decode() for k in range(i, j)])
            out.append(ids)
            sizes.append(size)
        return np.concatenate(out), np.concatenate(sizes)

    def learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        length = np.cumsum(ends - starts)
        own = cut_out(data, starts, ends)
        places = length - (ends - starts) + np.arange(len(starts))  # one space more before each word
        spaced = np.full(len(own) + len(starts), 32, np.uint8)
        inside = np.ones(len(spaced), bool)
        inside[places] = False
        spaced[inside] = own
        ids, sizes = self.after_space(spaced, places)
        last = np.cumsum(sizes)
        new = np.stack([length - (ends - starts) + len(self.letters), length + len(self.letters), last - sizes + len(self.ids), last + len(self.ids)])
        self.letters = np.concatenate([self.letters, own])
        self.ids = np.concatenate([self.ids, ids])
        joint = np.concatenate([self.hashes, hashes])
        order = np.argsort(joint, kind="stable")
        self.hashes, self.places = joint[order], np.concatenate([self.places, new.astype(np.int32)], axis=1)[:, order]

    def by_words(self, texts: list[bytes], spaced: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids of all texts, how many each has) of texts whose words have one space between them; None if two of their
        words, or one and a remembered one, share a hash. The first word follows a space if ``spaced``."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        found = words(data, np.cumsum([0, *map(len, texts)]), NOT_BLANK, SAME)
        first = np.zeros(len(found.hashes) + 1, bool)
        first[found.bounds[:-1]] = not spaced
        first = first[:-1]
        starts, ends = found.starts[~first], found.ends[~first]
        own, index, inverse = np.unique(found.hashes[~first], return_index=True, return_inverse=True)
        if not same_bytes(data, starts, ends, data, starts[index][inverse], ends[index][inverse]):
            return None
        at = np.searchsorted(self.hashes, own)
        new = np.ones(len(own), bool)
        new[at < len(self.hashes)] = self.hashes[at[at < len(self.hashes)]] != own[at < len(self.hashes)]
        old = self.places[:, at[~new]]
        if not same_bytes(data, starts[index][~new], ends[index][~new], self.letters, old[0], old[1]):
            return None
        if new.any():
            self.learn(data, own[new], starts[index][new], ends[index][new])
            at = np.searchsorted(self.hashes, own)
        opening, sizes = self.together([data[a:b].tobytes().decode() for a, b in zip(found.starts[first].tolist(), found.ends[first].tolist())])
        begin, end = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        begin[~first], end[~first] = self.places[2, at][inverse], self.places[3, at][inverse]
        end[first] = len(self.ids) + np.cumsum(sizes)
        begin[first] = end[first] - sizes
        flat = cut_out(np.concatenate([self.ids, opening]), begin, end)
        total = np.append(0, np.cumsum(end - begin))
        if len(self.hashes) > REMEMBERED_WORDS:
            self.forget()
        return flat, np.diff(total[found.bounds])

    def encode_all(self, texts: list[str], spaced: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, with a space before each if ``spaced``, one after the other, and how many each has."""
        odd = np.array([self.odd(t) for t in texts], bool)
        plain = self.by_words([t.encode() for t, o in zip(texts, odd) if not o], spaced) if not odd.all() else None
        if plain is None:
            odd[:] = True
        if not odd.any():
            return plain
        flat, sizes = self.together([" " + t if spaced else t for t, o in zip(texts, odd) if o])
        if odd.all():
            return flat, sizes
        both, counts = np.concatenate([flat, plain[0]]), np.empty(len(texts), np.int64)
        counts[odd], counts[~odd] = sizes, plain[1]
        begin = np.empty(len(texts), np.int64)
        begin[odd], begin[~odd] = np.cumsum(sizes) - sizes, len(flat) + np.cumsum(plain[1]) - plain[1]
        return cut_out(both, begin, begin + counts), counts

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of little-endian unsigned 32-bit integers."""
        flat, counts = self.encode_all(texts)
        data, ends = flat.astype("<u4").tobytes(), 4 * np.cumsum(counts)
        return [data[a:b] for a, b in zip((ends - 4 * counts).tolist(), ends.tolist())]


def same_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, begins: np.ndarray, finishes: np.ndarray) -> bool:
    """Whether all ranges of ``data`` hold what those of ``other`` hold."""
    return np.array_equal(ends - starts, finishes - begins) and np.array_equal(cut_out(data, starts, ends), cut_out(other, begins, finishes))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@contextmanager
def lent_encoder(path: str) -> Iterator[Encoder]:
    """The encoder for one task: its tokenizer stays loaded, its words are not kept by a worker that may be idle next."""
    lent = encoder(path)
    try:
        yield lent
    finally:
        lent.forget()


def binary_lengths(tokens: int, window: int) -> Iterator[int]:
    """Lengths of the pieces of a document: windows, then falling powers of two."""
    yield from piece_lengths(np.array([tokens]), window)[1].tolist()


def piece_lengths(tokens: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, length) of the pieces of documents of so many tokens, document by document."""
    each = np.arange(len(tokens))
    docs, lengths = [np.repeat(each, tokens // window)], [np.full(int((tokens // window).sum()), window, np.int64)]
    for bit in reversed(range(window.bit_length() - 1)):
        having = each[(tokens % window) >> bit & 1 > 0]
        docs.append(having)
        lengths.append(np.full(len(having), 1 << bit, np.int64))
    docs, lengths = np.concatenate(docs), np.concatenate(lengths)
    order = np.argsort(docs, kind="stable")
    return docs[order], lengths[order]


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], pa.DataType]]:
    """(keys, texts, type of the keys) of runs of rows with not many more than TEXTS_TOGETHER characters."""
    for given in batches:
        keys, texts, size = [], [], 0
        for key, value in zip(given.column(0), given.column(1)):
            keys.append(key.as_py())
            texts.append(value.as_py() or "")
            size += len(texts[-1])
            if size >= TEXTS_TOGETHER:
                yield keys, texts, given.column(0).type
                keys, texts, size = [], [], 0
        if keys:
            yield keys, texts, given.column(0).type


def pieces(df: DataFrame, key: str, text: str, tokenizer: str, window: int = 1024) -> DataFrame:
    """The pieces of every document: key, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit integers; ``window``, the longest length, is a power of two. A null
    or empty text is the separator alone, so it has one piece of length 1. A null key is kept, repeated rows are
    packed each, and columns other than ``key`` and ``text`` are not carried on. An empty frame gives no piece.
    A very long text is encoded whole, its pieces leave the task in small batches. ``sequence_id`` is unique: its
    highest bits are the bucket, so that sequences of one length have neighbouring numbers.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    bounded_batches(df.sparkSession)
    key_type = df.schema[key].dataType
    schema = T.StructType([
        T.StructField(key, key_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])

    def cut(encode: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        numbers = np.zeros(window.bit_length(), np.int64)
        for keys, texts, kind in runs(batches):
            flat, counts = encode(texts)
            tokens = counts + 1
            ends = np.cumsum(tokens)
            separator = np.zeros(ends[-1], bool)
            separator[ends - 1] = True
            ids = np.full(ends[-1], SEPARATOR, "<u4")
            ids[~separator] = flat
            doc, length = piece_lengths(tokens, window)
            bucket = np.log2(length).astype(np.int64)
            number = np.empty(len(doc), np.int64)
            for b in np.unique(bucket):
                own = np.flatnonzero(bucket == b)
                number[own] = numbers[b] + np.arange(len(own))
                numbers[b] += len(own)
            stop = np.cumsum(length)
            column = pa.BinaryArray.from_buffers if 4 * len(ids) < 1 << 31 else pa.LargeBinaryArray.from_buffers
            wide = np.int32 if 4 * len(ids) < 1 << 31 else np.int64
            kinds = pa.binary() if wide is np.int32 else pa.large_binary()
            held = column(kinds, len(doc), [None, pa.py_buffer(np.append(0, 4 * stop).astype(wide)), pa.py_buffer(ids)])
            columns = [
                pa.array(keys, kind).take(pa.array(doc)), pa.array(stop - length - (ends - tokens)[doc]), pa.array(length), held,
                pa.array(tokens[doc]), pa.array((bucket << TASK_BITS | task) << NUMBER_BITS | number), pa.array(np.zeros(len(doc), np.int64))]
            for i in range(0, len(doc), FLUSH_PIECES):
                part = [c.slice(i, FLUSH_PIECES) for c in columns]
                part[3] = part[3].cast(pa.binary())
                yield pa.RecordBatch.from_arrays(part, names=schema.names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with lent_encoder(tokenizer) as lent:
            yield from cut(lent.encode_all, batches)

    return df.select(key, F.col(text)).mapInArrow(giving_back(read), schema)


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write pieces as Parquet, a folder for each length."""
    packed.write.partitionBy("length").parquet(path)
