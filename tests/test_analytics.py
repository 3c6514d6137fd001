from datetime import date, timedelta
from functools import reduce

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tradeloom.operators import alerts, anomaly, stats, vwap
from tradeloom.operators.projections import bronze_enrich, window_flatten
from tradeloom.plans import registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trades(spark, sf):
    return registry.trades(spark, sf)


@pytest.fixture(scope="module")
def silver(trades):
    return window_flatten(vwap.vwap(trades, "1 minute")).persist()


@pytest.fixture(scope="module")
def silver5(trades):
    return window_flatten(vwap.vwap(trades, "5 minutes")).persist()


def test_vwap_bounds(silver):
    odd = "vwap < low_price - 1e-9 OR vwap > high_price + 1e-9 OR buy_ratio NOT BETWEEN 0 AND 1"
    assert silver.where(odd).count() == 0


def test_every_trade_is_in_one_window(trades, silver):
    assert silver.agg(F.sum("trade_count")).first()[0] == trades.count()


def test_five_minutes_are_the_sum_of_their_minutes(silver, silver5):
    by5 = silver.groupBy(F.window("window_start", "5 minutes")["start"].alias("window_start"), "ticker").agg(F.sum("total_volume"))
    assert rows(by5) == rows(silver5, "window_start", "ticker", "total_volume")


def test_fewer_alerts_at_higher_thresholds(trades):
    found = [anomaly.anomaly_by_bucket(trades, threshold=t).count() for t in (0.0, 0.005, 0.01, 0.02, 0.05)]
    assert found == sorted(found, reverse=True) and found[2] == 430 and found[-1] == 0


def test_threshold_is_strict_and_average_includes_the_trade(spark):
    df = spark.createDataFrame([("a", "X", 99.0), ("b", "X", 101.0), ("c", "Y", 5.0)], "trade_id string, ticker string, price double")
    for c, t in (("quantity", "int"), ("side", "string"), ("source", "string"), ("event_time", "timestamp")):
        df = df.withColumn(c, F.lit(None).cast(t))
    assert anomaly.anomaly_self_join(df, 0.01).count() == 0
    assert rows(anomaly.anomaly_self_join(df, 0.0099), "trade_id", "direction") == [("a", "below"), ("b", "above")]


def test_window_of_several_sources_takes_the_least(spark):
    df = spark.createDataFrame(
        [("X", 10.0, 1, "buy", "z"), ("X", 20.0, 3, "unknown", "a"), ("X", 30.0, 0, "sell", None)],
        "ticker string, price double, quantity int, side string, source string",
    ).withColumn("event_time", F.lit("2026-06-06 10:00:30").cast("timestamp"))
    r = vwap.vwap(df, "1 minute").first()
    assert (r["vwap"], r["total_volume"], r["trade_count"], r["low_price"], r["high_price"]) == (17.5, 4, 3, 10.0, 30.0)
    assert r["buy_ratio"] == pytest.approx(1 / 3) and r["source"] == "a"


def test_window_without_volume_has_no_vwap(spark):
    df = spark.createDataFrame([("X", 10.0, 0, "buy", "s")], "ticker string, price double, quantity int, side string, source string")
    df = df.withColumn("event_time", F.lit("2026-06-06 10:00:30").cast("timestamp"))
    assert vwap.vwap(df, "1 minute").first()["vwap"] is None


def test_trades_are_aggregated_by_hash(spark, trades):
    """The text column must not force a sort of all trades."""
    df = trades.withColumn("source", F.col("trade_type"))
    text = plan(vwap.vwap(df, "1 minute"))
    below = text[text.rindex("partial_sum(notional"):]
    assert "Sort" not in below.split("FileScan")[0]


def test_coverage_counts_windows_of_one_side(spark, sf, trades, silver):
    bronze = registry.bronze(spark, sf)
    r = vwap.vwap_reconcile_coverage(bronze, silver.where("ticker <> 'TK01'"), registry.DAY).first()
    assert (r["matched"], r["batch_only"], r["stream_only"]) == (96, 4, 0)
    r = vwap.vwap_reconcile_coverage(bronze.where("ticker <> 'TK01'"), silver, registry.DAY).first()
    assert (r["matched"], r["batch_only"], r["stream_only"]) == (96, 0, 4)


def test_reconcile_reads_one_day(spark, sf, silver):
    bronze = bronze_enrich(registry.trades(spark, sf))
    assert vwap.vwap_reconcile(bronze, silver, date(2026, 6, 8)).count() == 0


def test_bucket_join_has_no_range_condition(silver, silver5):
    text = plan(vwap.window_divergence(silver, silver5))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert vwap.window_divergence(silver, silver5).count() == 225


def test_top_rows_use_a_bounded_sort(spark, sf):
    for name in ("vwap_dashboard", "vwap_reconcile", "vwap_1m_vs_5m", "top_tickers"):
        assert "TakeOrderedAndProject" in plan(registry.QUERIES[name](spark, sf)), name


def test_no_query_pairs_all_rows(spark, small_sf):
    for name in ("vwap_1min", "vwap_reconcile", "anomaly_by_bucket", "vwap_reconcile_coverage", "dq_checks", "alert_digest"):
        text = plan(registry.QUERIES[name](spark, small_sf))
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_profile_scans_once(spark, trades):
    df = stats.batch_profile(trades)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 1
    assert stats.batch_sample(trades, 5).count() == 5


def test_totals_of_an_empty_table(spark, trades):
    r = stats.totals(trades.where("price < 0")).first()
    assert (r["total_records"], r["unique_tickers"], r["earliest_trade"]) == (0, 0, None)


def gold(spark, *data):
    schema = "file string, trade_id string, ticker string, price double, window_avg_price double, deviation_pct double"
    return spark.createDataFrame(data, schema)


def test_digest_keeps_alerts_without_ticker_in_the_total(spark):
    g = gold(
        spark, ("f1", "a", "X", 11.0, 10.0, 0.1), ("f1", "b", None, 11.0, 10.0, 0.1), ("f2", "c", None, 1.0, 1.0, 0.2),
    )
    got = {(r["file"], r["ticker"]): r for r in alerts.alert_digest(g, "file").collect()}
    assert set(got) == {("f1", None), ("f1", "X"), ("f2", None)}
    assert got["f1", None]["subject"] == "Off-average prices: 1 tickers, 2 trades"
    assert got["f1", "X"]["body"].startswith("X: 1 alerts") and "10.00% on average" in got["f1", "X"]["body"]
    assert got["f2", None]["body"].startswith("f2\n1 alerts on 0 tickers")


@pytest.mark.parametrize("tickers", [3, 700])
def test_digest_has_one_form_at_any_size(spark, tickers):
    g = gold(spark, *[("f", f"t{i}", f"X{i:03d}", 11.0, 10.0, 0.1) for i in range(tickers)], ("f", "n", None, 1.0, 1.0, 0.2))
    got = alerts.alert_digest(g, "file").collect()
    assert sorted(r["ticker"] for r in got if r["ticker"]) == [f"X{i:03d}" for i in range(tickers)]
    heads = [r for r in got if r["ticker"] is None]
    assert [r["subject"] for r in heads] == [f"Off-average prices: {tickers} tickers, {tickers + 1} trades"]


def test_digest_threshold_comes_from_the_setting(spark):
    g = gold(spark, ("f", "a", "X", 11.0, 10.0, 0.1))
    assert "by more than 2.5%" in alerts.alert_digest(g, "file", threshold=0.025).where("ticker IS NULL").first()["body"]


def test_newest_windows_by_hash_aggregate(spark, silver, tmp_path):
    silver.write.parquet(str(tmp_path / "silver"))
    df = vwap.vwap_latest(spark.read.parquet(str(tmp_path / "silver")))
    assert "SortAggregate" not in plan(df)
    assert df.count() == 25 and df.select("window_start").distinct().count() == 1


def test_coverage_ends_with_the_day_and_knows_windows_without_ticker(spark, trades):
    late = trades.withColumn("ticker", F.when(F.col("ticker") != "TK03", F.col("ticker")))
    bronze, own = bronze_enrich(late), window_flatten(vwap.vwap(late, "1 minute"))
    for day, n in ((registry.DAY, 4 * 25), (registry.DAY + timedelta(days=1), 5 * 25)):
        assert tuple(vwap.vwap_reconcile_coverage(bronze, own, day).first()) == (n, 0, 0)
        assert vwap.reconcile_windows(bronze, own, day).count() == n


def test_coverage_has_every_stored_day(spark, monkeypatch, trades):
    """A week of trades: days after the second count as well."""
    days = trades.withColumn("event_time", F.col("event_time") + F.make_dt_interval(F.col("quantity") % 7))
    bronze, own = bronze_enrich(days), window_flatten(vwap.vwap(days, "1 minute"))
    lacking = own.where("window_start < timestamp'2026-06-10' OR ticker <> 'TK01'")
    monkeypatch.setattr(registry, "_late_layers", lambda spark, sf: (bronze, lacking))
    got = {r["day"]: tuple(r)[1:] for r in registry.QUERIES["vwap_reconcile_coverage"](spark, "").collect()}
    assert sorted(got) == [f"2026-06-{d:02d}" for d in range(6, 14)]
    for day, counts in got.items():
        assert counts == tuple(vwap.vwap_reconcile_coverage(bronze, lacking, date.fromisoformat(day)).first())
    assert sum(c[1] for c in got.values()) > 0


def test_summary_leaves_rows_without_ticker_out(spark):
    g = gold(spark, ("f", "a", "X", 11.0, 10.0, 0.1), ("f", None, "X", 13.0, 10.0, 0.3), ("f", "c", None, 1.0, 1.0, 0.2))
    r = alerts.alert_summary(g, "file").collect()
    assert len(r) == 1 and r[0]["alerts"] == 1
    assert (r[0]["avg_price"], r[0]["max_deviation"]) == (12.0, 0.3)


def test_reconciliation_grows_with_the_table(spark, sf, small_sf):
    """All stored days are compared: the windows of bronze that silver has, on both sides of midnight."""
    counts = {}
    for folder in (small_sf, sf):
        bronze, silver = registry.bronze(spark, folder), registry.silver(spark, folder)
        found = vwap.reconcile_all_windows(bronze, silver)
        counts[folder] = found.count()
        assert counts[folder] == silver.count()
        days = [r["day"] for r in found.selectExpr("CAST(to_date(minute) AS string) AS day").distinct().orderBy("day").collect()]
        by_day = sum(vwap.reconcile_windows(bronze, silver, date.fromisoformat(d)).count() for d in days)
        assert by_day == counts[folder]
    assert len(days) == 2 and counts[sf] > 5 * counts[small_sf]
    assert vwap.vwap_reconcile(bronze, silver).count() == 50


def test_longer_windows_merge_from_partials(spark, sf):
    """The same rows as from the trades, for lengths that the stored ones divide; partial results may be split at will."""
    trades = registry.trades(spark, sf)
    partials = vwap.vwap_partials(trades)
    pieces = [vwap.vwap_partials(trades.where(F.pmod(F.xxhash64("trade_id"), F.lit(3)) == i)) for i in range(3)]
    columns = ["window.start", "ticker", "round(vwap, 6)", "total_volume", "trade_count", "low_price", "high_price", "round(buy_ratio, 9)", "source"]
    for duration in ("1 minute", "2 minutes", "5 minutes", "1 hour"):
        want = rows(vwap.vwap(trades, duration).selectExpr(*columns))
        for given in (partials, reduce(lambda a, b: a.unionByName(b), pieces)):
            assert rows(vwap.merge_partials(given, duration).selectExpr(*columns)) == want


def test_both_window_lengths_read_the_trades_once(spark, sf):
    """Both come from partial results that are written down; the trades are in no plan any more."""
    df = vwap.window_divergence(*registry.silver_pair(spark, sf))
    assert plan(df).count("Scan ExistingRDD") == 2 and "FileScan" not in plan(df)
