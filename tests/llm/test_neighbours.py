import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.llm import neighbours
from tradeloom.llm.queries import op3_neighbours


def exact(ids, x, query, k):
    scores = x @ x[query]
    held = [(-scores[i], ids[i]) for i in range(len(ids)) if ids[i] != ids[query]]
    return [(rank, i, -s) for rank, (s, i) in enumerate(sorted(held)[:k], 1)]


def found(df, k, **more):
    out = neighbours.nearest(df, "id", "v", F.col("id") % 5 == 0, k=k, **more).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return by


def test_rotations_keep_lengths():
    x = np.random.default_rng(1).normal(size=(20, 64))
    for t in range(3):
        y = neighbours.rotations(x, t)
        assert np.allclose((x @ x.T), y @ y.T)
    assert np.allclose(neighbours.hadamard(neighbours.hadamard(x)), x)


def test_a_bucket_is_the_nearest_signed_axis():
    x = np.random.default_rng(2).normal(size=(50, 32))
    y = neighbours.rotations(x, 0)
    both = np.concatenate([y, -y], 1)
    assert (neighbours.bucket_of(x, 0) == both.argmax(1)).all()
    probes = neighbours.probed(x, 0, 1 / 64)
    assert (probes.argmax(1) == both.argmax(1)).all() and (probes.sum(1) == 1).all()


def test_everything_probed_is_exact_with_ties_copies_and_lengths(spark):
    random = np.random.default_rng(3)
    x = random.integers(-3, 4, size=(300, 6)).astype(np.float32) * random.integers(1, 4, size=(300, 1)).astype(np.float32)
    x[(x == 0).all(1)] = 1
    x[100:180] = x[7]  # copies, more of them than any answer can name
    df = spark.createDataFrame([(int(i), v.tolist(), "mine") for i, v in enumerate(x)], "id long, v array<float>, name string")
    got = found(df, 4, share=1.0)
    wide = x.astype(float)
    assert got == {q: exact(list(range(300)), wide, q, 4) for q in range(0, 300, 5)}


def test_small_blocks_change_nothing(spark, monkeypatch):
    x = np.random.default_rng(4).normal(size=(200, 8))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    one = found(df, 3)
    monkeypatch.setattr(neighbours, "INDEX_BLOCK", 20)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 10)
    other = found(df, 3)
    assert {q: [r[:2] for r in v] for q, v in one.items()} == {q: [r[:2] for r in v] for q, v in other.items()}


def test_vectors_that_take_no_part(spark):
    bad = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0]]
    rows = [(i, v) for i, v in enumerate(bad)] + [(None, [1.0, 1.0]), (10, [1.0, 0.5]), (11, [2.0, 1.0]), (15, [1.0, 2.0, 3.0]), (20, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert found(df, 5, share=1.0) == {10: [(1, 11, 2.5), (2, 20, -1.0)], 20: [(1, 10, -1.0), (2, 11, -2.0)]}
    assert found(df.limit(0), 5) == {}


def test_an_id_of_two_vectors_is_no_answer_to_itself(spark):
    df = spark.createDataFrame([(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 1.0])], "id long, v array<double>")
    out = neighbours.nearest(df, "id", "v", F.col("id") == 5, k=3, share=1.0).collect()
    assert {r["vec_id"] for r in out} == {6}


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, name):
    folder = f"/root/testdata/{name}"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    out = op3_neighbours(spark, folder).toPandas()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        want = {i for _, i, _ in exact(ids, x, q, 20)}
        own = out[out["query_id"] == ids[q]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and own["score"].is_monotonic_decreasing
        at = np.searchsorted(ids, own["vec_id"])
        assert np.allclose(x[at] @ x[q], own["score"], rtol=0, atol=1e-12)
        hits, total = hits + len(want & set(own["vec_id"])), total + 20
    assert hits / total >= 0.9


def test_many_blocks_meet_over_many_tasks(spark, monkeypatch):
    """Each block of the index meets each strip of queries also where tasks are not merged."""
    monkeypatch.setattr(neighbours, "INDEX_BLOCK", 16)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    x = np.random.default_rng(6).normal(size=(150, 5))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        got = found(df, 3, share=1.0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {q: [r[1] for r in v] for q, v in got.items()} == {q: [r[1] for r in exact(list(range(150)), x, q, 3)] for q in range(0, 150, 5)}


def own_recall(spark, x):
    """Recall of the 20 nearest, over the queries that get 20 answers; the number of queries that do not."""
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = found(df, 20)
    hits = [len({r[1] for r in exact(list(range(len(x))), x, q, 20)} & {r[1] for r in got.get(q, [])}) for q in range(0, len(x), 5)]
    return sum(hits) / (20 * len(hits)), sum(len(got.get(q, [])) < 20 for q in range(0, len(x), 5))


@pytest.mark.parametrize("times", [3, 10, 100])
def test_recall_where_lengths_differ(spark, times):
    random = np.random.default_rng(times)
    x = random.normal(size=(1200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    one, half, spread = x.copy(), x.copy(), x * times ** random.random((1200, 1))
    one[17] *= times
    half[::2] *= times
    for lengths in (one, half, spread):
        share, short = own_recall(spark, lengths)
        assert share >= 0.9 and short == 0


def test_answers_of_no_positive_product_are_exact(spark):
    x = np.abs(np.random.default_rng(8).normal(size=(700, 6))) + 0.1
    x[0] = -1
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    out = neighbours.nearest(df, "id", "v", F.col("id") == 0, k=20).collect()
    assert [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"])] == [r[1] for r in exact(list(range(700)), x, 0, 20)]


def test_no_more_candidates_than_asked_for_are_all_answers(spark):
    x = np.random.default_rng(7).normal(size=(21, 64))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = found(df, 20)
    assert {q: [r[1] for r in v] for q, v in got.items()} == {q: [r[1] for r in exact(list(range(21)), x, q, 20)] for q in range(0, 21, 5)}
