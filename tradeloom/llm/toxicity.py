"""Toxicity by a factorization machine over hashed terms.

The score of a text is logistic in a sum of a weight for each of its terms and, for each pair of its terms, the
inner product of their factors. Pairs that never met in training are scored too, through the factors that each
term learned from others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.learning import label_odds, score_column, training_rows
from tradeloom.llm.textarrays import LETTERS, column_bytes, slices, words

BUCKET_BITS = 20
TRAINING_ROWS = 8000  # bound of the sample that the machine is fitted on
TERMS = 2048
LEAST_DOCUMENTS = 5  # of the sample, that a term must occur in
FACTORS = 8
ROUNDS = 150
RATE = 0.05
DECAY = 2e-3


@dataclass
class Machine:
    place: np.ndarray  # bucket of a hashed term -> its row below, or -1
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, column: pa.Array) -> np.ndarray:
        """Log odds of each text."""
        data, offsets = column_bytes(column)
        out = np.full(len(column), self.bias)
        n, self_pairs = len(self.weights), (self.factors ** 2).sum(1)
        for i, j in slices(offsets):
            row, term = pairs(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], self.place)
            if not len(row):
                continue
            linear = np.bincount(row, self.weights[term], j - i)
            sums = np.stack([np.bincount(row, self.factors[term, f], j - i) for f in range(self.factors.shape[1])], 1)
            out[i:j] += linear + 0.5 * ((sums ** 2).sum(1) - np.bincount(row, self_pairs[term], j - i))
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(column), -500, 500)))


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every term occurrence; terms are runs of letters."""
    found = words(data, offsets, LETTERS)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(found.bounds))
    return row, (found.hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def pairs(data: np.ndarray, offsets: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) for each distinct known term of each row."""
    row, bucket = buckets(data, offsets)
    term = place[bucket]
    known = term >= 0
    width = int(place.max(initial=-1)) + 1 or 1
    distinct = np.unique(row[known] * width + term[known])
    return distinct // width, distinct % width


def sample_terms(rows: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct buckets and label of each sampled row; extracted by the tasks, collected as bounded by the sample."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            labels = batch.column(1)
            for i, j in slices(offsets):
                row, bucket = buckets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                bounds = np.searchsorted(row, np.arange(j - i + 1))
                own = [np.unique(bucket[a:b]).astype(np.int32) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), labels[i:j]], names=["terms", "label"])

    found = rows.mapInArrow(extract, "terms array<int>, label int").toArrow()
    # the order of the rows must not depend on which task ended first
    terms = [np.asarray(t.values) for t in found.column("terms").combine_chunks()] if len(found) else []
    labels = np.asarray(found.column("label"), float) if len(found) else np.zeros(0)
    order = sorted(range(len(terms)), key=lambda i: (labels[i], len(terms[i]), terms[i].tobytes()))
    return [terms[i] for i in order], labels[order] if len(order) else labels


def fit(terms: list[np.ndarray], labels: np.ndarray, odds: float, seed: int = 7) -> Machine:
    """Fit a machine to distinct buckets per row; ``odds`` are the log odds of label 1 among all labelled rows.

    The TERMS most telling terms (largest difference between observed and expected counts, by chi-square) take
    part. Without rows of both labels the machine knows the odds alone.
    """
    place = np.full(1 << BUCKET_BITS, -1, np.int64)
    n, ones = len(labels), labels.sum()
    if not n or ones in (0, n):
        return Machine(place, odds, np.zeros(1), np.zeros((1, FACTORS)))
    flat = np.concatenate(terms)
    row = np.repeat(np.arange(n), [len(t) for t in terms])
    seen = np.bincount(flat, minlength=1 << BUCKET_BITS).astype(float)
    with_one = np.bincount(flat, labels[row], 1 << BUCKET_BITS)
    expected = seen * ones / n
    with np.errstate(divide="ignore", invalid="ignore"):
        telling = (with_one - expected) ** 2 / (expected * (1 - seen / (n + 1)))
    telling[seen < LEAST_DOCUMENTS] = -1
    chosen = np.argsort(-telling, kind="stable")[:TERMS]
    chosen = chosen[telling[chosen] > 0]
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((n, max(1, len(chosen))), np.float32)
    known = place[flat] >= 0
    x[row[known], place[flat[known]]] = 1

    random = np.random.default_rng(seed)
    values = [np.float32(0), np.zeros(x.shape[1], np.float32), random.normal(0, 0.02, (x.shape[1], FACTORS)).astype(np.float32)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, ROUNDS + 1):
        bias, weights, factors = values
        sums = x @ factors
        raw = bias + x @ weights + 0.5 * ((sums ** 2).sum(1) - x @ (factors ** 2).sum(1))
        error = (1 / (1 + np.exp(-np.clip(raw, -60, 60))) - labels).astype(np.float32) / n
        slopes = [
            error.sum(), x.T @ error + DECAY / n * weights * 100,
            x.T @ (error[:, None] * sums) - factors * (x.T @ error)[:, None] + DECAY / n * factors * 100,
        ]
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope ** 2
            values[k] = (values[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    bias, weights, factors = values
    return Machine(place, float(bias) + odds - float(np.log(ones / (n - ones))), weights.astype(float), factors.astype(float))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", target: str = "toxic",
          rows: int = TRAINING_ROWS) -> Machine:
    """A machine fitted on at most ``rows`` labelled documents, of folds 1 to 4 only."""
    return fit(*sample_terms(training_rows(docs, labels, key, text, target, rows)), label_odds(labels, key, target))


def score(docs: DataFrame, machine: Machine, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability, 0 to 1, that each whole text is toxic, in ``into``.

    A null or empty text, or one without known terms, gets the score of the bias. Repeated rows are scored each; an
    empty frame stays empty. Other columns are not looked at; one named as ``into`` is replaced.
    """
    return docs.withColumn(into, score_column(F.col(text), machine, docs.sparkSession))
