import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tradeloom.llm import shards
from tradeloom.llm.queries import op1_sharding


def plain_jump(key, count):
    key, b, j = key % 2**64, -1, 0
    while j < count:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_is_the_published_one():
    keys = np.array([0, 1, 2, 10, 2**40, -1, -(2**62), 2**63 - 1])
    for count in (1, 2, 7, 24, 1000):
        assert shards.jump(keys, count).tolist() == [plain_jump(int(k), count) for k in keys]


def test_growing_moves_rows_only_into_the_new_shard():
    keys = np.arange(50_000)
    old, new = shards.jump(keys, 24), shards.jump(keys, 25)
    moved = old != new
    assert set(new[moved]) == {24}
    assert abs(moved.mean() - 1 / 25) < 0.005
    counts = np.bincount(old)
    assert counts.min() > 0.9 * counts.mean()


def test_bad_count():
    with pytest.raises(ValueError):
        shards.shard_of("x", 0)


def test_slots_nulls_repeats_and_clashing_names(spark):
    rows = [(k, f"x{i}", 7, 8) for i, k in enumerate([None, None, 5, 5, 5, 3, -2, 9, 9] + list(range(100, 160)))]
    df = spark.createDataFrame(rows, "id long, _row string, _part int, _before int")
    out = shards.number_slots(shards.assign_shards(df, "id", 4), "shard", "id").collect()
    assert len(out) == len(rows) and sorted(r["_row"] for r in out) == sorted(r[1] for r in rows)
    by = defaultdict(list)
    for r in out:
        assert r["shard"] == plain_jump(r["id"] or 0, 4) and (r["_part"], r["_before"]) == (7, 8)
        by[r["shard"]].append((r["slot"], r["id"]))
    for held in by.values():
        held.sort()
        assert [s for s, _ in held] == list(range(len(held)))
        ids = [-(2**63) if k is None else k for _, k in held]
        assert ids == sorted(ids)


def test_empty(spark):
    df = shards.assign_shards(spark.createDataFrame([], "id long"), "id", 3)
    assert shards.number_slots(df, "shard", "id").count() == 0


def test_one_hot_key_fills_one_shard_over_many_ranges(spark):
    df = spark.range(3000).selectExpr("IF(id < 1000, 42, id) AS id")
    out = shards.number_slots(shards.assign_shards(df, "id", 5), "shard", "id").collect()
    for shard, n in Counter(r["shard"] for r in out).items():
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(n))


def test_query(spark, sf):
    got = {r["doc_id"]: r for r in op1_sharding(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        r, content = got[d["doc_id"]], (d["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(content) + 8, zlib.crc32(content), "key")
        assert (r["shard"], r["grown_shard"]) == (plain_jump(d["doc_id"], 24), plain_jump(d["doc_id"], 25))
