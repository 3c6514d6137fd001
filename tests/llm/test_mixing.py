import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradeloom.llm import mixing
from tradeloom.llm.queries import op5_mixing


def frame(spark, rows):
    return spark.createDataFrame([(i, s, t, "w" * 3, 1.5) for i, (s, t) in enumerate(rows)],
                                 "id long, source string, n long, tokens string, weight double")


def passes(df, **how):
    return Counter(r["id"] for r in mixing.mix(df, "source", F.col("n"), ["id"], **how).collect())


def test_a_limit_on_passes(spark):
    rows = [("big", 10)] * 900 + [("small", 10)] * 60 + [(None, 10)] * 300
    df = frame(spark, rows)
    out = mixing.mix(df, "source", F.col("n"), ["id"], max_repeats=2.0)
    assert out.columns == df.columns
    seen = passes(df, max_repeats=2.0)
    assert len(seen) == len(rows)  # nothing is lost
    per = {s: [seen[i] for i, r in enumerate(rows) if r[0] == s] for s in ("big", "small", None)}
    assert set(per["big"]) == {1} and set(per["small"]) == {2} and set(per[None]) == {1, 2}
    exponent = 1 + math.log(2) / math.log(60 / 900)
    assert abs(sum(per[None]) - 300 * (300 / 900) ** (exponent - 1)) <= 1


def test_a_budget_and_an_entropy(spark):
    rows = [("a", 10)] * 800 + [("b", 10)] * 200
    df = frame(spark, rows)
    seen = passes(df, budget=5000, target_entropy=0.9)
    tokens = Counter()
    for i, n in seen.items():
        tokens[rows[i][0]] += 10 * n
    assert abs(sum(tokens.values()) - 5000) <= 20
    p = tokens["b"] / 5000
    assert abs(-p * math.log2(p) - (1 - p) * math.log2(1 - p) - 0.9) < 0.01
    assert passes(df, budget=5000, target_entropy=5.0).keys()  # more than can be: the flattest
    flat = Counter(rows[i][0] for i in passes(df, budget=4000).elements())
    assert abs(flat["a"] - flat["b"]) <= 2
    assert Counter(rows[i][0] for i in passes(df, budget=10_000, max_repeats=1.0).elements()) == {"a": 800, "b": 200}


def test_nulls_empty_and_rows_alike(spark):
    assert passes(frame(spark, []), max_repeats=2.0) == {}
    assert passes(frame(spark, [("a", None), ("a", 0), (None, None)]), max_repeats=2.0) == {0: 1, 1: 1, 2: 1}
    twin = spark.createDataFrame([(1, "a", 5)] * 40 + [(2, "b", 5)] * 10, "id long, source string, n long")
    seen = Counter(r["id"] for r in mixing.mix(twin, "source", F.col("n"), ["id"], max_repeats=3.0).collect())
    assert seen[1] == 40 and seen[2] == 30


def test_wide_plans_are_joined_by_a_shuffle(spark, monkeypatch):
    df = frame(spark, [(f"s{i % 7}", 1 + i % 5) for i in range(200)])
    one = passes(df, max_repeats=2.0)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert passes(df, max_repeats=2.0) == one


def test_query(spark, sf):
    rows = op5_mixing(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text").collect()
    sizes, total = {d["doc_id"]: len(d["text"].split()) for d in docs}, Counter()
    seen = Counter(r["doc_id"] for r in rows)
    assert set(seen) == set(sizes)
    for d in docs:
        total[d["source"]] += sizes[d["doc_id"]]
    used, epochs = Counter(), {r["source"]: r["epochs"] for r in rows}
    for r in rows:
        assert r["tokens"] == sizes[r["doc_id"]]
        used[r["source"]] += r["tokens"]
    for s, n in total.items():
        longest = max(sizes[d["doc_id"]] for d in docs if d["source"] == s)
        assert 0 <= used[s] - epochs[s] * n + 1 <= longest + 2
    assert min(epochs.values()) == pytest.approx(1) and max(epochs.values()) <= 2.0 + 1e-9
