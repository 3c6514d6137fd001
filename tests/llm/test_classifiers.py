import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import learning, quality, toxicity
from tradeloom.llm.queries import op2_quality, op4_toxicity
from tradeloom.llm.textarrays import LETTERS, words

DATA = "/root/testdata/sf0.1"


def measured(spark, rows, target):
    labels = {r["doc_id"]: r[target] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    held = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    s, y, p = (np.array(c) for c in zip(*held))
    order = np.argsort(np.argsort(s))
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    return auc, (p[y == 1] == 1).mean(), (p[y == 0] == 1).mean()


def test_fold_is_the_crc_of_the_key(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "k long").select("k", learning.fold(F.col("k")).alias("f")).collect()
    assert all(r["f"] == (0 if r["k"] is None else zlib.crc32(str(r["k"]).encode()) % 5) for r in rows)


def test_quality_on_held_out_documents(spark):
    rows = op2_quality(spark, DATA).collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 for r in rows)
    auc, kept, slipped = measured(spark, rows, "quality")
    assert auc > 0.99 and kept > 0.99 and slipped < 0.05


def test_toxicity_on_held_out_documents(spark):
    rows = op4_toxicity(spark, DATA).collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 for r in rows)
    auc, caught, wrong = measured(spark, rows, "toxic")
    assert auc > 0.93 and caught > 0.8 and wrong < 0.02


def test_messages_are_those_of_all_labellings():
    random = np.random.default_rng(0)
    bounds = np.array([0, 1, 5, 5 + 3])
    score, link = random.normal(size=8), random.normal(size=(2, 2))
    forward, backward = quality.messages(score, bounds, link)
    got = 1 / (1 + np.exp(-(forward + backward)))
    for a, b in zip(bounds[:-1], bounds[1:]):
        total, good = 0.0, np.zeros(b - a)
        for labels in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(score[a + t] * y for t, y in enumerate(labels)) + sum(link[i, j] for i, j in zip(labels, labels[1:])))
            total += w
            good += w * np.array(labels)
        assert np.allclose(got[a:b], good / total)


def test_lines_are_those_of_split():
    texts = ["", "\n", "one\ntwo\n\nthree", "no break", "éé A1!\n"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    found = quality.lines_of(data, offsets)
    assert np.diff(found.bounds).tolist() == [len(t.split("\n")) for t in texts]
    assert found.lengths.tolist() == [len(x) for t in texts for x in t.split("\n")]


def test_the_machine_scores_pairs(monkeypatch):
    machine = toxicity.Machine(np.full(1 << toxicity.BUCKET_BITS, -1), 0.3, np.array([1.0, -2.0, 0.5]), np.random.default_rng(1).normal(size=(3, 4)))
    terms = ["alpha", "beta", "gamma"]
    for i, t in enumerate(terms):
        data = np.frombuffer(t.encode(), np.uint8)
        machine.place[int(words(data, np.array([0, len(data)]), LETTERS).hashes[0] >> np.uint64(64 - toxicity.BUCKET_BITS))] = i
    texts = ["Alpha, beta beta!", "GAMMA", "other", "", None, "gamma alpha beta " * 30_000]
    want = []
    for t in texts:
        on = [i for i, w in enumerate(terms) if w in (t or "").lower()]
        want.append(0.3 + machine.weights[on].sum() + sum(machine.factors[i] @ machine.factors[j] for i, j in itertools.combinations(on, 2)))
    assert np.allclose(machine.raw(pa.array(texts)), want)


def test_the_machine_learns_a_pair():
    random = np.random.default_rng(5)
    rows, labels = [], []
    for _ in range(2000):  # only both terms together are toxic
        on = [b for b in (10, 20) if random.random() < 0.5]
        rows.append(np.array(sorted([*on, *random.integers(100, 140, 3)]), np.int32))
        labels.append(float(len(on) == 2))
    rows = [np.unique(r) for r in rows]
    machine = toxicity.fit(rows, np.array(labels), float(np.log(np.mean(labels) / (1 - np.mean(labels)))))

    def odds(on):
        at = machine.place[on]
        at = at[at >= 0]
        v = machine.factors[at]
        return machine.bias + machine.weights[at].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v ** 2).sum())

    assert odds([10, 20]) > 0 > max(odds([10]), odds([20]), odds([100]))


@pytest.mark.parametrize("module,target", [(quality, "quality"), (toxicity, "toxic")])
def test_nulls_empty_long_repeated_and_clashing_names(spark, module, target):
    docs = [(i, "\n".join(["good words here again"] * 3) if i % 2 else "BAD!! ### worthless $$$ junk", 1.0) for i in range(200)]
    docs += [(None, "x", 2.0), (900, None, 3.0), (901, "", 4.0), (901, "", 4.0), (902, "word " * 200_000, 5.0)]
    labels = [(i, i % 2 if target == "quality" else 1 - i % 2) for i in range(200)] + [(None, 1), (900, None), (3, 0 if target == "toxic" else 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, label double")
    known = spark.createDataFrame(labels, f"doc_id long, {target} int")
    model = module.train(df, known)
    out = module.score(df, model).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] <= 1 for r in out)
    by = {r["doc_id"]: r["score"] for r in out}
    assert (by[1] > 0.5 > by[2]) if target == "quality" else (by[2] > 0.5 > by[1])
    assert by[900] == by[901] and module.score(df.limit(0), model).count() == 0
    untaught = module.train(df.limit(0), known.limit(0))
    assert {round(r["score"], 6) for r in module.score(df, untaught).collect()} == {0.5}


def test_a_sample_is_bounded_and_leaves_the_held_out_fold_alone(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    labels = spark.range(1000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    rows = learning.training_rows(docs, labels, "doc_id", "text", "toxic", 100).collect()
    assert len(rows) == 100 and sum(r["label"] for r in rows) == 50
    assert all(zlib.crc32(r["text"].encode()) % 5 for r in rows)
