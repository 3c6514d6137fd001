"""Checks from profiles of days against the same checks over the whole table."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tradeloom.operators import profiles, quality
from tradeloom.operators.projections import bronze_enrich
from tradeloom.schema import BRONZE_PARTITIONS, TABLES

AS_OF = datetime(2026, 6, 10)
DAYS = [date(2026, 6, 6), date(2026, 6, 7), date(2026, 6, 8), None]
SCHEMA = ("trade_id string, ticker string, price double, quantity int, side string, trade_type string, bid_price double, "
          "ask_price double, exchange string, source string, event_time timestamp, ingested_at timestamp")


def trades(seed, day, n=60):
    """Trades of a day, with faults and with ids that other days and other rows have too."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        at = None if day is None else datetime(day.year, day.month, day.day) + timedelta(seconds=rng.randrange(86_400))
        trade_id = None if rng.random() < 0.1 else f"t{rng.randrange(120)}"
        out.append((trade_id, rng.choice(["A", "B", None]), rng.choice([10.0, 0.0, -1.0]), rng.choice([1, 0, None]),
                    rng.choice(["buy", "hold", None]), "market", 9.9, rng.choice([10.1, 9.0]), "X", "s", at, None))
    return out


def store(spark, path, data):
    bronze_enrich(spark.createDataFrame(data, SCHEMA)).drop("ingested_at").withColumn(
        "ingested_at", F.lit(None).cast("timestamp")).write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(path)


def bronze(spark, path):
    return spark.read.schema(TABLES["bronze_raw_trades"][0]).parquet(path)


def same(spark, table, store_path):
    want = rows(quality.dq_checks(bronze(spark, table), quality.ALL, AS_OF))
    assert rows(profiles.profiled_checks(spark, store_path)) == want
    assert rows(quality.report_of(profiles.profiled_checks(spark, store_path, quality.GATE))) == rows(
        quality.gate_report(bronze(spark, table), quality.GATE, AS_OF))


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (2, 3, 0, 1)])
def test_days_in_any_order(spark, tmp_path, order):
    table, store_path = str(tmp_path / "b"), str(tmp_path / "p")
    for i in order:
        store(spark, table, trades(i, DAYS[i]))
        profiles.profile_days(bronze(spark, table), [DAYS[i]], store_path, AS_OF)
        same(spark, table, store_path)


def test_several_days_at_once_and_late_trades(spark, tmp_path):
    """Two days together, then late trades for an old day, which is profiled again, alone and along with a new one."""
    table, store_path = str(tmp_path / "b"), str(tmp_path / "p")
    store(spark, table, trades(1, DAYS[0]) + trades(2, DAYS[1]))
    profiles.profile_days(bronze(spark, table), DAYS[:2], store_path, AS_OF)
    same(spark, table, store_path)
    store(spark, table, trades(3, DAYS[0]))
    profiles.profile_days(bronze(spark, table), [DAYS[0]], store_path, AS_OF)
    same(spark, table, store_path)
    store(spark, table, trades(4, DAYS[1]) + trades(5, DAYS[2]) + trades(6, None))
    profiles.profile_days(bronze(spark, table), DAYS[1:], store_path, AS_OF)
    same(spark, table, store_path)
    profiles.profile_days(bronze(spark, table), DAYS, store_path, AS_OF)
    same(spark, table, store_path)
    ids = profiles.owned_ids(spark, store_path)
    assert ids.count() == ids.select("trade_id").distinct().count()


def test_a_day_without_trades_and_no_profile_at_all(spark, tmp_path):
    table, store_path = str(tmp_path / "b"), str(tmp_path / "p")
    assert {r["violations"] for r in profiles.profiled_checks(spark, store_path).collect()} == {0}
    store(spark, table, trades(1, DAYS[0]))
    profiles.profile_days(bronze(spark, table), [DAYS[0], DAYS[1]], store_path, AS_OF)
    same(spark, table, store_path)
    assert profiles.day_counts(spark, store_path).where(F.col("day") == str(DAYS[1])).first()["rows"] == 0


def test_a_profile_that_fails_does_not_count(spark, tmp_path, monkeypatch):
    table, store_path = str(tmp_path / "b"), str(tmp_path / "p")
    store(spark, table, trades(1, DAYS[0]))
    profiles.profile_days(bronze(spark, table), [DAYS[0]], store_path, AS_OF)
    before = rows(profiles.profiled_checks(spark, store_path))
    store(spark, table, trades(2, DAYS[1]))
    real = profiles._next
    monkeypatch.setattr(profiles, "_next", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        profiles.profile_days(bronze(spark, table), [DAYS[1]], store_path, AS_OF)
    assert rows(profiles.profiled_checks(spark, store_path)) == before
    monkeypatch.setattr(profiles, "_next", real)
    profiles.profile_days(bronze(spark, table), [DAYS[1]], store_path, AS_OF)
    same(spark, table, store_path)


def test_a_profile_reads_its_days_only(spark, tmp_path):
    table = str(tmp_path / "b")
    store(spark, table, trades(1, DAYS[0]) + trades(2, DAYS[1]) + trades(3, None))
    plan = bronze(spark, table).where(profiles.on_days([DAYS[1]]))
    assert {f.split("/day=")[1].split("/")[0] for f in plan.inputFiles()} == {"6", "7", "__HIVE_DEFAULT_PARTITION__"}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "DataFilters: []" in text
    read = plan.select("trade_id", F.input_file_name().alias("f")).selectExpr("f").distinct().collect()
    assert {f["f"].split("/day=")[1].split("/")[0] for f in read} == {"7"}
