"""Text quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are counts of its own characters and words and those of the lines before
and after; neighbouring labels influence each other. A document's quality is the average, weighted by length, of
the probabilities that its lines are good.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.learning import score_column, training_rows
from tradeloom.llm.textarrays import byte_table, column_bytes, mixed, slices, words

TRAINING_ROWS = 6000  # bound of the sample that the field is fitted on
ROUNDS = 250
RATE = 0.05
DECAY = 1e-3

NEWLINE = 10
UPPER = byte_table(bytes(range(65, 91)))
LETTER = byte_table(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(192, 256)))
DIGIT = byte_table(bytes(range(48, 58)))
SYMBOL = byte_table(b"#&$%*!|<>{}[]=_^~@\\/+")
STOP = byte_table(b".,;:?")
NEXT_BYTE = byte_table(bytes(range(128, 192)))  # of a character beyond ASCII

OWN = 13
FEATURES = 3 * OWN + 1


@dataclass
class Lines:
    """Features of lines, their lengths in characters, and for each row the range of its lines."""

    features: np.ndarray
    lengths: np.ndarray
    bounds: np.ndarray


def lines_of(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """The lines of each row. A row has at least one, an empty text an empty one."""
    rows = len(offsets) - 1
    breaks = np.flatnonzero(data == NEWLINE)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    row_of_break = np.searchsorted(offsets, breaks, "right") - 1
    counts = np.bincount(row_of_break, minlength=rows) + 1
    bounds = np.concatenate([[0], np.cumsum(counts)])
    ends = np.empty_like(starts)
    ends[bounds[1:] - 1] = offsets[1:]
    inner = np.ones(len(starts), bool)
    inner[bounds[1:] - 1] = False
    ends[inner] = breaks
    n = len(starts)

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        return (sums[ends] - sums[starts]).astype(float)

    size = (ends - starts) - count(NEXT_BYTE)
    letters, upper, digits, symbols, stops = (count(t) for t in (LETTER, UPPER, DIGIT, SYMBOL, STOP))

    found = words(data, starts_to_offsets(starts, len(data)))
    amount = np.diff(found.bounds)[:n].astype(float)
    line_of_word = np.repeat(np.arange(n), np.diff(found.bounds)[:n])
    tagged = np.sort(line_of_word.astype(np.uint64) << np.uint64(32) | found.hashes >> np.uint64(32))
    first = np.concatenate([[True], tagged[1:] != tagged[:-1]])[:len(tagged)]
    distinct = np.bincount((tagged[first] >> np.uint64(32)).astype(np.int64), minlength=n).astype(float)
    same = np.zeros(len(found.hashes), bool)
    same[1:] = (found.hashes[1:] == found.hashes[:-1]) & (line_of_word[1:] == line_of_word[:-1])
    repeats = np.bincount(line_of_word[same], minlength=n).astype(float)

    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(found.hashes + np.uint64(1)), dtype=np.uint64)])
    whole = sums[found.bounds[1:n + 1]] - sums[found.bounds[:n]]
    row_of_line = np.repeat(np.arange(rows), counts)
    order = np.lexsort((whole, row_of_line))
    again = np.zeros(n, bool)
    again[1:] = (whole[order][1:] == whole[order][:-1]) & (row_of_line[order][1:] == row_of_line[order][:-1])
    seen = np.zeros(n)
    seen[order] = again
    seen[amount == 0] = 0

    some, worded = np.maximum(size, 1), np.maximum(amount, 1)
    per_symbol, fresh = symbols / some, np.where(amount > 0, distinct / worded, 1.0)
    own = np.stack([
        np.log1p(size), upper / np.maximum(letters, 1), digits / some, per_symbol, (per_symbol > 0.02).astype(float),
        stops / some, letters / some, np.log1p(size / worded), fresh, ((fresh < 0.5) & (amount > 8)).astype(float),
        repeats / worded, seen, (amount < 3).astype(float),
    ], 1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[bounds[:-1]], after[bounds[1:] - 1] = own[bounds[:-1]], own[bounds[1:] - 1]
    return Lines(np.concatenate([own, before, after, np.ones((n, 1))], 1), size, bounds)


def starts_to_offsets(starts: np.ndarray, end: int) -> np.ndarray:
    return np.concatenate([starts, [end]])


def _longest_first(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line of each row, longest row first; and how many rows have more than t lines, for each t."""
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    active = len(counts) - np.searchsorted(np.sort(counts), np.arange(counts.max(initial=0)), "right")
    return bounds[:-1][order], active


def messages(score: np.ndarray, bounds: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages as log odds of good, all rows stepping together.

    ``score`` has each line's own log odds, ``link[i, j]`` the weight of label j after label i.
    """
    first, active = _longest_first(bounds)
    forward, backward = score.copy(), np.zeros_like(score)
    for t in range(1, len(active)):
        now = first[:active[t]] + t
        a = forward[now - 1]
        forward[now] += np.logaddexp(a + link[1, 1], link[0, 1]) - np.logaddexp(a + link[1, 0], link[0, 0])
    for t in range(len(active) - 1, 0, -1):
        now = first[:active[t]] + t
        b = score[now] + backward[now]
        backward[now - 1] = np.logaddexp(link[1, 1] + b, link[1, 0]) - np.logaddexp(link[0, 1] + b, link[0, 0])
    return forward, backward


@dataclass
class Field:
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    link: np.ndarray

    def line_odds(self, found: Lines) -> np.ndarray:
        """Probability that each line is good, given all lines of its row."""
        own = ((found.features - self.middle) / self.spread) @ self.weights
        forward, backward = messages(own, found.bounds, self.link)
        return 1.0 / (1.0 + np.exp(-np.clip(forward + backward, -500, 500)))

    def score(self, column: pa.Array) -> np.ndarray:
        data, offsets = column_bytes(column)
        out = np.empty(len(column))
        for i, j in slices(offsets):
            found = lines_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            good, weight = self.line_odds(found), found.lengths + 1
            out[i:j] = np.add.reduceat(good * weight, found.bounds[:-1]) / np.add.reduceat(weight, found.bounds[:-1])
        return out


def fit(found: Lines, labels: np.ndarray) -> Field:
    """Fit a field by maximum likelihood; each line of a row carries the row's label.

    Without rows of both labels every line is as good as the other and scores one half.
    """
    n = len(labels)
    if not n or labels.sum() in (0, n):
        return Field(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)))
    middle, spread = found.features.mean(0), found.features.std(0) + 1e-6
    middle[-1], spread[-1] = 0, 1
    x = (found.features - middle) / spread
    y = np.repeat(labels, np.diff(found.bounds)).astype(float)
    inner = np.ones(len(y), bool)
    inner[found.bounds[:-1]] = False
    later = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[later - 1].astype(int), y[later].astype(int)), 1)

    values = np.zeros(FEATURES + 4)
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, ROUNDS + 1):
        weights, link = values[:FEATURES], values[FEATURES:].reshape(2, 2)
        own = x @ weights
        forward, backward = messages(own, found.bounds, link)
        good = 1 / (1 + np.exp(-np.clip(forward + backward, -60, 60)))
        a, b = forward[later - 1], own[later] + backward[later]
        joint = np.stack([np.full(len(later), link[0, 0]), link[0, 1] + b, a + link[1, 0], a + link[1, 1] + b], 1)
        joint = np.exp(joint - joint.max(1, keepdims=True))
        joint /= joint.sum(1, keepdims=True)
        slope = np.concatenate([x.T @ (good - y), joint.sum(0) - seen.ravel()]) / n + DECAY * values
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope ** 2
        values = values - RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Field(middle, spread, values[:FEATURES], values[FEATURES:].reshape(2, 2))


def sample_lines(rows: DataFrame) -> tuple[Lines, np.ndarray]:
    """Lines and label of each sampled row; extracted by the tasks, collected as bounded by the sample."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            for i, j in slices(offsets):
                found = lines_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                per_row = zip(found.bounds[:-1], found.bounds[1:])
                packed = [found.features[a:b].astype(np.float32).tobytes() for a, b in per_row]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1)[i:j]], names=["lines", "label"])

    got = rows.mapInArrow(extract, "lines binary, label int").toArrow().to_pydict()
    # the order of the rows must not depend on which task ended first
    both = sorted(zip(got["label"], got["lines"]))
    rows_of = [np.frombuffer(x, np.float32).reshape(-1, FEATURES).astype(float) for _, x in both]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows_of])]).astype(np.int64)
    features = np.concatenate(rows_of) if rows_of else np.zeros((0, FEATURES))
    return Lines(features, np.zeros(len(features)), bounds), np.array([v for v, _ in both])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", target: str = "quality",
          rows: int = TRAINING_ROWS) -> Field:
    """A field fitted on at most ``rows`` labelled documents, of folds 1 to 4 only."""
    return fit(*sample_lines(training_rows(docs, labels, key, text, target, rows)))


def score(docs: DataFrame, field: Field, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the quality, 0 to 1, of each whole text in ``into``.

    A null or empty text is one empty line and gets that line's probability. Repeated rows are scored each; an empty
    frame stays empty. Other columns are not looked at; one named as ``into`` is replaced.
    """
    return docs.withColumn(into, score_column(F.col(text), field, docs.sparkSession))
