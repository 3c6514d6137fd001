import pytest
from pyspark.sql import functions as F

from helpers import rows
from tradeloom.operators import anomaly, skew
from tradeloom.operators.jumps import price_jump
from tradeloom.sources import replay


@pytest.fixture(scope="module")
def lopsided(spark, sf):
    """The replayed trades with one ticker holding more than a third of them, some of them copies."""
    trades = replay.trades_of(replay.events(spark, sf)).drop("event_type", "value")
    hot = trades.withColumn("ticker", F.when(F.xxhash64("trade_id") % 3 == 0, "TK00").otherwise(F.col("ticker")))
    copies = hot.orderBy("trade_id").limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(4000)))).drop("n")
    return hot.union(copies).repartition(8).persist()


@pytest.fixture
def always_shuffle(monkeypatch):
    plain = skew.join_group_stats
    monkeypatch.setattr(
        anomaly, "join_group_stats", lambda *a, **k: plain(*a, broadcast_bytes=-1, hot_groups=20, **k)
    )


def by_window_function(df, group):
    from pyspark.sql import Window

    avg = F.avg("price").over(Window.partitionBy(*group))
    dev = F.abs(F.col("price") - F.col("a")) / F.col("a")
    return df.withColumn("a", avg).where(dev > 0.01).select("trade_id")


def test_shuffled_join_equals_definition(lopsided, always_shuffle):
    got = anomaly.anomaly_self_join(lopsided)
    assert "salt" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "trade_id") == rows(by_window_function(lopsided, ["ticker"]))


def test_shuffled_bucket_join_equals_definition(lopsided, always_shuffle):
    got = anomaly.anomaly_by_bucket(lopsided)
    want = by_window_function(lopsided.withColumn("b", F.window("event_time", "30 seconds")["start"]), ["b", "ticker"])
    assert rows(got, "trade_id") == rows(want)


def test_small_statistics_are_broadcast(lopsided):
    plan = anomaly.anomaly_self_join(lopsided)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "salt" not in plan


def test_hot_groups_are_spread_over_partitions(spark, lopsided):
    stats = anomaly.ticker_batch_avg(lopsided)
    joined = skew.join_group_stats(lopsided, stats, ["ticker"], "window_trade_count", -1, 100)
    assert joined.count() == lopsided.where("ticker IS NOT NULL").count()
    # With 20 parts and more for the hot ticker, several of the four shuffle partitions hold it.
    spread = (
        lopsided.join(stats, "ticker")
        .withColumn("parts", F.ceil(F.col("window_trade_count") / (lopsided.count() // 100)))
        .where("ticker = 'TK00'")
        .agg(F.max("parts"))
        .first()[0]
    )
    assert spread > 20


def test_null_tickers_fall_out(spark, lopsided, always_shuffle):
    df = lopsided.withColumn("ticker", F.when(F.col("side") == "sell", F.lit(None)).otherwise(F.col("ticker")))
    assert anomaly.anomaly_self_join(df).where("ticker IS NULL OR side = 'sell'").count() == 0


def test_no_trades_no_alerts(spark, lopsided, always_shuffle):
    assert anomaly.anomaly_self_join(lopsided.where("price < 0")).count() == 0


def largest_steps(df):
    got = {}
    last = {}
    for r in sorted(df.collect(), key=lambda r: (r["ticker"], r["event_time"], r["trade_id"], r["price"])):
        t = r["ticker"]
        got.setdefault(t, None)
        if t in last and last[t] != 0:
            step = abs(r["price"] - last[t]) / last[t] * 100
            got[t] = step if got[t] is None else max(got[t], step)
        last[t] = r["price"]
    return got


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_price_jump_against_brute_force(spark, lopsided, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r["ticker"]: r["max_jump_pct"] for r in price_jump(lopsided).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == largest_steps(lopsided)


def test_price_jump_of_hot_ticker_uses_many_partitions(spark, lopsided):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = ["ticker", "event_time", "trade_id", "price"]
        spread = (
            lopsided.withColumn("read_in", F.spark_partition_id())
            .repartitionByRange(*order, "read_in")
            .where("ticker = 'TK00'")
            .groupBy(F.spark_partition_id())
            .count()
        )
        assert spread.count() >= 2
        assert price_jump(lopsided).count() == 25
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_price_jump_edge_cases(spark):
    data = [
        ("one", "2026-06-06 10:00:00", "a", 5.0),
        ("zero", "2026-06-06 10:00:00", "a", 0.0), ("zero", "2026-06-06 10:00:01", "b", 5.0), ("zero", "2026-06-06 10:00:02", "c", 6.0),
        ("tie", "2026-06-06 10:00:00", "b", 110.0), ("tie", "2026-06-06 10:00:00", "a", 100.0),
        (None, "2026-06-06 10:00:00", "a", 1.0), ("gone", None, "a", 1.0),
    ]
    df = spark.createDataFrame(data, "ticker string, t string, trade_id string, price double").withColumn(
        "event_time", F.col("t").cast("timestamp")
    )
    got = {r["ticker"]: (r["max_jump_pct"], r["flagged"]) for r in price_jump(df, 20.0).collect()}
    assert got == {"one": (None, False), "zero": (20.0, True), "tie": (10.0, False)}
