from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import quality as q
from tradeloom.operators.stats import duplicate_ids
from tradeloom.sources import replay

AS_OF = datetime(2026, 6, 6, 12, 0)
CLEAN = ("t1", "AAPL", 10.0, 5, "buy", AS_OF, 9.9, 10.1)
SCHEMA = (
    "trade_id string, ticker string, price double, quantity int, side string, event_time timestamp, "
    "bid_price double, ask_price double"
)


def checks(spark, *rows, names=q.ALL):
    df = spark.createDataFrame([CLEAN, *rows], SCHEMA)
    return {r["check_name"]: r["violations"] for r in q.dq_checks(df, names, AS_OF).collect()}


def changed(**by):
    return tuple(by.get(f.split()[0], v) for f, v in zip(SCHEMA.split(", "), (("t2",) + CLEAN[1:])))


@pytest.mark.parametrize(
    "rows, name, n",
    [
        ([changed(trade_id=None)], "null_trade_id", 1),
        ([changed(ticker=None)], "null_ticker", 1),
        ([changed(price=0.0), changed(trade_id="t3", price=-1.0)], "negative_price", 2),
        ([changed(quantity=0)], "zero_quantity", 1),
        ([changed(side="hold"), changed(trade_id="t3", side=None)], "invalid_side", 1),
        ([changed(event_time=None)], "null_timestamp", 1),
        ([changed(event_time=AS_OF + timedelta(minutes=6)), changed(trade_id="t3", event_time=AS_OF + timedelta(minutes=5))], "future_trades", 1),
        ([changed(trade_id="t1")], "duplicate_ids", 1),
        ([changed(trade_id=None), changed(trade_id=None)], "duplicate_ids", 2),
    ],
)
def test_one_spoiled_field_counts_in_its_check_only(spark, rows, name, n):
    got = checks(spark, *rows)
    assert got[name] == n
    others = {k: v for k, v in got.items() if v and k != name}
    # A missing id also counts as surplus to the distinct ones.
    assert set(others) <= {"duplicate_ids", "null_trade_id"} if "trade_id" in name or name == "duplicate_ids" else not others


def test_check_sets():
    assert len(q.ALL) == 8 and len(q.VALIDATION) == 7 and len(q.GATE) == 7
    assert "duplicate_ids" not in q.VALIDATION and "future_trades" not in q.GATE


def test_spread_skips_nulls(spark):
    got = checks(spark, changed(bid_price=None), changed(trade_id="t3", ask_price=9.0), names=("spread",))
    assert got == {"spread": 1}


def test_gate_passes_and_raises(spark):
    clean = spark.createDataFrame([CLEAN], SCHEMA)
    assert q.dq_gate(clean) == {"status": "ALL_DQ_CHECKS_PASSED", "checks_run": 7, "violations": 0}
    with pytest.raises(q.DataQualityError) as e:
        q.dq_gate(clean.union(clean).union(spark.createDataFrame([changed(price=-1.0)], SCHEMA)))
    assert sorted(e.value.failures) == [("duplicate_ids", 1), ("negative_price", 1)]


def test_empty_table_passes(spark):
    assert q.dq_gate(spark.createDataFrame([], SCHEMA))["violations"] == 0


def test_row_rules_take_one_pass(spark, small_sf):
    df = replay.dirtied(replay.trades_of(replay.events(spark, small_sf)), AS_OF)
    plan = q.dq_checks(df, q.VALIDATION, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    both = q.dq_checks(df, q.ALL, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert both.count("FileScan") == 2


def test_copies_of_one_id_collapse_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("trade_id"))
    assert [tuple(r) for r in duplicate_ids(df).collect()] == [("same", 10_000)]
