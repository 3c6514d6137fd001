"""The log of micro-batches, open windows in state, counts from footers."""

import json
import time
from types import SimpleNamespace

from pyspark.sql import functions as F

from helpers import deliver, rows, trade
from tradeloom.operators.projections import window_flatten
from tradeloom.operators.vwap import vwap
from tradeloom.plans import registry
from tradeloom.schema import SILVER, TABLES
from tradeloom.sources import commits, state, tables
from tradeloom.sources.feed import resolve_payload, stream_source
from tradeloom.streaming import sinks
from tradeloom.streaming.progress import ProgressLog, batch_written_counts, progress_reports, trigger_starts


def event(batch, query="q", read=10, written=9):
    progress = SimpleNamespace(
        id=query, batchId=batch, timestamp=f"2026-06-06T10:{batch // 60:02d}:{batch % 60:02d}.015Z", durationMs={"triggerExecution": 5},
        numInputRows=read, observedMetrics={sinks.WRITTEN: {"rows": written}}, stateOperators=[])
    return SimpleNamespace(progress=progress)


def test_500_micro_batches_leave_a_handful_of_files(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "p"), roll_bytes=40_000)
    for n in range(500):
        log.onQueryProgress(event(n))
    log.flush()
    assert 1 <= len(list((tmp_path / "p").glob("*.json"))) <= 5
    counts = batch_written_counts(spark, log.path)
    assert counts.count() == 500
    assert tuple(counts.agg(F.sum("rows_read"), F.sum("rows_written")).first()) == (5000, 4500)


def test_reports_outlive_a_driver_that_is_lost(spark, tmp_path):
    """Reports that were flushed are there though no file was closed; a line cut short and a repeated report do no harm."""
    lost = ProgressLog(spark, str(tmp_path / "p"))
    for n in range(50):
        lost.onQueryProgress(event(n))
    for _ in range(400):
        if lost.reported.get("q") == 49:
            break
        time.sleep(0.05)
    open_file = next((tmp_path / "p").glob("*.json"))
    with open(open_file, "a") as f:
        f.write(json.dumps({"query_id": "q", "batch_id": 50})[:20])
    again = ProgressLog(spark, str(tmp_path / "p"))
    for n in range(49, 60):
        again.onQueryProgress(event(n))
    again.flush()
    counts = batch_written_counts(spark, str(tmp_path / "p"))
    assert [r[0] for r in rows(counts, "batch_id")] == list(range(60))
    assert progress_reports(spark, str(tmp_path / "p")).count() == 60


def test_starts_against_the_interval(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "p"))
    for n in (0, 1, 3):
        log.onQueryProgress(event(n))
    log.onQueryProgress(event(7, read=0))
    log.flush()
    assert rows(trigger_starts(spark, log.path, 1000), "batch_id", "after_ms", "since_ms") == [(0, 15, None), (1, 15, 1000), (3, 15, 2000)]


def test_closed_and_open_windows_are_all_windows(spark, sf, tmp_path):
    """In either form of the stream, and across a restart."""
    want = rows(window_flatten(vwap(registry.trades(spark, sf), "1 minute")).selectExpr("window_start", "ticker", "round(vwap, 6)", "trade_count", "source"))
    key = "spark.sql.streaming.statefulOperator.allowMultiple"
    for multiple in ("true", "false"):
        place = tmp_path / multiple
        spark.conf.set(key, multiple)
        try:
            for half in registry._halves(spark, sf):
                payloads = registry.replay.wire_of(half).select(registry.feed.trade_payload().alias("value"))
                payloads.write.mode("append").text(str(place / "feed"))
                wire = resolve_payload(stream_source(spark, "text", {"path": str(place / "feed")}))
                sinks.silver_sink(wire, str(place / "s"), str(place / "c"), "1 minute", trigger=None).awaitTermination()
        finally:
            spark.conf.unset(key)
        closed = spark.read.schema(SILVER).parquet(str(place / "s")).drop("computed_at")
        left = state.open_windows(spark, str(place / "c"))
        assert 0 < left.count() < len(want)
        both = closed.unionByName(left)
        assert rows(both.selectExpr("window_start", "ticker", "round(vwap, 6)", "trade_count", "source")) == want


def test_partial_results_still_open(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(1, "A", "00:10"), trade(2, "A", "05:00", price=50.0)])
    wire = resolve_payload(stream_source(spark, "text", {"path": str(tmp_path / "feed")}))
    sinks.partials_sink(wire, str(tmp_path / "p"), str(tmp_path / "c"), trigger=None).awaitTermination()
    left = state.open_partials(spark, str(tmp_path / "c"))
    assert rows(left, "ticker", "source", "notional", "volume", "trades", "buys", "low", "high") == [("A", "test", 500.0, 10, 1, 1, 50.0, 50.0)]


def test_counts_come_from_footers(spark, small_sf, tmp_path):
    cfg = registry._stored_batch(spark, small_sf, *TABLES)
    paths = {t: cfg.table_path(t) for t in TABLES}
    found = tables.footer_counts(spark, paths)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedAggregation: [COUNT(*)]") == len(TABLES) and "FileScan" not in text
    assert dict(found.collect()) == {t: spark.read.parquet(p).count() for t, p in paths.items()}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_counts_of_missing_and_committed_tables(spark, tmp_path):
    commits.commit(spark, str(tmp_path / "g"), 0, ["part-a"], 10, 3)
    found = tables.footer_counts(spark, {"gold_anomaly_alerts": str(tmp_path / "g"), "silver_vwap_1min": str(tmp_path / "none")})
    assert dict(found.collect()) == {"gold_anomaly_alerts": 3, "silver_vwap_1min": 0}
