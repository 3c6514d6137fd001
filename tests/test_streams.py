import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helpers import deliver, rows, trade
from tradeloom.config import Config
from tradeloom.operators.anomaly import anomaly_by_bucket, anomaly_self_join
from tradeloom.operators.projections import window_flatten
from tradeloom.operators.vwap import closed_windows, vwap
from tradeloom.plans.medallion import medallion_run
from tradeloom.operators.quality import DataQualityError
from tradeloom.sources import replay
from tradeloom.sources.feed import resolve_payload, stream_source, trade_payload
from tradeloom.sources.tables import alert_file_scan, alert_file_stream, read_table
from tradeloom.streaming import sinks
from tradeloom.streaming.progress import ProgressLog, batch_written_counts


def feed(spark, folder, per_batch=1):
    options = {"path": str(folder), "maxFilesPerTrigger": str(per_batch)}
    return resolve_payload(stream_source(spark, "text", options))


@pytest.fixture
def progress(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    yield log
    spark.streams.removeListener(log)


def silver_of(spark, tmp, duration="1 minute"):
    q = sinks.silver_sink(feed(spark, tmp / "feed"), str(tmp / "silver"), str(tmp / "cp_silver"), duration, trigger=None)
    q.awaitTermination()
    return q


def late_rows(folder):
    files = [
        [("A", "00:10"), ("B", "05:00")],
        [("A", "00:30"), ("A", "04:30"), ("A", None)],
        [("B", "07:00"), ("A", "00:40")],
        [("A", "05:30"), ("A", "06:59")],
    ]
    i = 0
    for n, batch in enumerate(files):
        deliver(folder, n, [trade(i := i + 1, t, w) for t, w in batch])


@pytest.mark.parametrize(
    "multiple, want, dropped",
    [
        ("true", [(0, "A", 2), (4, "A", 1), (5, "A", 1), (5, "B", 1)], [0, 0, 1, 0]),
        ("false", [(0, "A", 1), (4, "A", 1), (5, "B", 1)], [0, 1, 1, 1]),
    ],
)
def test_late_rows(spark, tmp_path, progress, multiple, want, dropped):
    late_rows(tmp_path / "feed")
    key = "spark.sql.streaming.statefulOperator.allowMultiple"
    spark.conf.set(key, multiple)
    try:
        q = silver_of(spark, tmp_path)
    finally:
        spark.conf.unset(key)
    out = read_table(spark, str(tmp_path / "silver"), "silver_vwap_1min")
    assert rows(out, F.minute("window_start"), "ticker", "trade_count") == want
    progress.settle(q)
    counted = batch_written_counts(spark, progress.path)
    counts = counted.groupBy().agg(F.sum("rows_late"), F.sum("rows_written"), F.sum("rows_read")).first()
    assert tuple(counts) == (sum(dropped), len(want), 9)
    late = [r["rows_late"] for r in counted.orderBy("batch_id").collect()]
    assert [x for x in late if x] == [x for x in dropped if x]


def test_streamed_trades_are_aggregated_by_hash(spark, tmp_path):
    """The text column must not force a sort of all trades: it is a key of the first aggregate."""
    late_rows(tmp_path / "feed")
    text = silver_of(spark, tmp_path)._jsq.explainInternal(False)
    below = text[text.rindex("partial_sum(notional"):]
    assert "HashAggregate" in text and "Sort" not in below.split("Scan")[0]


@pytest.fixture(scope="module")
def bucket_files(spark, sf, tmp_path_factory):
    """The replayed trades as one payload file per 30 seconds, in time order."""
    folder = tmp_path_factory.mktemp("buckets")
    trades = replay.trades_of(replay.events(spark, sf))
    slot = F.unix_seconds("event_time") / 30
    payloads = (
        trades.withColumn("slot", F.floor(slot)).withColumn("timestamp", F.date_format("event_time", replay.ISO))
        .select("slot", trade_payload().alias("p")).collect()
    )
    first = min(r["slot"] for r in payloads)
    by_slot = {}
    for r in payloads:
        by_slot.setdefault(r["slot"] - first, []).append(r["p"])
    for n in sorted(by_slot):
        deliver(folder / "feed", n, by_slot[n])
    return folder


@pytest.mark.parametrize("duration, expected", [("1 minute", 200), ("5 minutes", 25)])
def test_streamed_silver_equals_batch(spark, sf, bucket_files, tmp_path, duration, expected):
    q = sinks.silver_sink(feed(spark, bucket_files / "feed"), str(tmp_path / "s"), str(tmp_path / "c"), duration, trigger=None)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p.numInputRows]) == 17
    trades = replay.trades_of(replay.events(spark, sf))
    columns = ["window_start", "ticker", F.round("vwap", 6), "total_volume", "trade_count", "low_price", "high_price", "buy_ratio", "source"]
    want = rows(closed_windows(window_flatten(vwap(trades, duration)), trades), *columns)
    got = rows(read_table(spark, str(tmp_path / "s"), "silver_vwap_1min"), *columns)
    assert len(got) == expected
    assert got == want


def test_streamed_gold_equals_bucket_detection(spark, sf, bucket_files, tmp_path):
    """One file per batch and one bucket per file make the batch average the bucket's average."""
    path = str(tmp_path / "gold")
    sinks.gold_sink(feed(spark, bucket_files / "feed"), path, str(tmp_path / "c"), trigger=None).awaitTermination()
    want = anomaly_by_bucket(replay.trades_of(replay.events(spark, sf)))
    assert rows(alert_file_scan(spark, path), "trade_id", "direction") == rows(want, "trade_id", "direction")
    assert want.count() == 430


def micro_batch(spark, *prices):
    schema = "trade_id string, ticker string, price double, quantity int, side string, source string, event_time timestamp"
    return spark.createDataFrame([(*p, 1, "buy", "test", None) for p in prices], schema)


def test_gold_batch_can_run_twice(spark, tmp_path):
    path = str(tmp_path / "gold")
    write = sinks.foreach_batch_anomaly(path)
    batch = micro_batch(spark, ("a", "X", 100.0), ("b", "X", 110.0), ("c", None, 5.0))
    for _ in range(2):
        write(batch, 3)
    write(batch, 4)
    found = read_table(spark, path, "gold_anomaly_alerts")
    assert rows(found, "batch_id", "trade_id") == [(3, "a"), (3, "b"), (4, "a"), (4, "b")]
    sinks.foreach_batch_anomaly(path, threshold=0.5)(batch, 3)  # repeated with another threshold
    assert rows(read_table(spark, path, "gold_anomaly_alerts"), "batch_id", "trade_id") == [(4, "a"), (4, "b")]


def test_nothing_flagged_no_file(spark, tmp_path):
    path = tmp_path / "gold"
    batch = micro_batch(spark, ("a", "X", 100.0))
    write = sinks.foreach_batch_anomaly(str(path))
    write(batch, 0)
    write(batch.limit(0), 1)
    assert not list(path.rglob("*.parquet"))


def test_a_batch_leaves_nothing_under_the_checkpoint_folder(spark, tmp_path):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    sinks.foreach_batch_anomaly(str(tmp_path / "gold"))(micro_batch(spark, ("a", "X", 100.0), ("b", "X", 110.0)), 0)
    assert set(os.listdir(folder)) == before


def test_bronze_resumes_where_it_stopped(spark, tmp_path):
    def run():
        sinks.bronze_append(feed(spark, tmp_path / "feed"), str(tmp_path / "b"), str(tmp_path / "c"), None).awaitTermination()
        return read_table(spark, str(tmp_path / "b"), "bronze_raw_trades").count()

    deliver(tmp_path / "feed", 0, [trade(1), trade(2)])
    assert run() == 2
    deliver(tmp_path / "feed", 1, [trade(3)])
    assert run() == 3
    assert run() == 3


def test_busy_ticker_is_written_by_several_tasks(spark, tmp_path):
    """Eight deliveries in one batch, half the trades in one ticker: its partition is split, others are not."""
    for n in range(8):
        busy = [trade(f"{n}-{i}", "HOT", price=i + 0.123 * n) for i in range(3000)]
        deliver(tmp_path / "feed", n, busy + [trade(f"{n}+{i}", f"T{i % 5}") for i in range(1500)])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    # One file per read task
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600KB")
    try:
        wire = feed(spark, tmp_path / "feed", per_batch=8)
        sinks.bronze_append(wire, str(tmp_path / "b"), str(tmp_path / "c"), None).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    table = read_table(spark, str(tmp_path / "b"), "bronze_raw_trades")
    assert table.count() == 8 * 4500
    files = [f for f in table.inputFiles()]
    assert sum("ticker=HOT" in f for f in files) > 1
    assert all(sum(f"ticker=T{i}/" in f for f in files) == 1 for i in range(5))


def test_batch_repeated_after_a_crash_counts_once(spark, tmp_path):
    """Files left by a batch that never committed, and a commit that was lost, leave no double rows."""
    deliver(tmp_path / "feed", 0, [trade(i) for i in range(9)])

    def run():
        sinks.bronze_append(feed(spark, tmp_path / "feed"), str(tmp_path / "b"), str(tmp_path / "c"), None).awaitTermination()
        return read_table(spark, str(tmp_path / "b"), "bronze_raw_trades").count()

    assert run() == 9
    # Forget that batch 0 was committed: the query runs it again over the same offsets.
    for f in (tmp_path / "c" / "commits").iterdir():
        if f.name in ("0", ".0.crc"):
            f.replace(tmp_path / f"lost{f.name}")
    assert run() == 9


def test_gold_batch_repeated_after_a_crash_counts_once(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(1, price=100.0), trade(2, price=110.0)])

    def run():
        sinks.gold_sink(feed(spark, tmp_path / "feed"), str(tmp_path / "g"), str(tmp_path / "c"), trigger=None).awaitTermination()
        return read_table(spark, str(tmp_path / "g"), "gold_anomaly_alerts").count()

    assert run() == 2
    for f in (tmp_path / "c" / "commits").iterdir():
        if f.name in ("0", ".0.crc"):
            f.replace(tmp_path / f"lost{f.name}")
    assert run() == 2


def test_bounded_run_stops_the_queries(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(1)])
    q = sinks.bronze_append(feed(spark, tmp_path / "feed"), str(tmp_path / "b"), str(tmp_path / "c"), "1 second")
    assert q.isActive
    sinks.bounded_run([q], 3)
    assert not q.isActive
    assert read_table(spark, str(tmp_path / "b"), "bronze_raw_trades").count() == 1


def test_bounded_run_reports_a_failed_query(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(1)])

    def broken(df, n):
        raise RuntimeError("no")

    wire = feed(spark, tmp_path / "feed")
    ok = sinks.bronze_append(wire, str(tmp_path / "b"), str(tmp_path / "c1"), "1 second")
    bad = wire.writeStream.foreachBatch(broken).option("checkpointLocation", str(tmp_path / "c2")).start()
    with pytest.raises(StreamingQueryException):
        sinks.bounded_run([bad, ok], 30)
    assert not ok.isActive


def test_bounded_run_reports_a_failure_within_seconds(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(1)])

    def broken(df, n):
        raise RuntimeError("no")

    wire = feed(spark, tmp_path / "feed")
    ok = sinks.bronze_append(wire, str(tmp_path / "b"), str(tmp_path / "c1"), "1 second")
    bad = wire.writeStream.foreachBatch(broken).option("checkpointLocation", str(tmp_path / "c2")).start()
    began = time.monotonic()
    with pytest.raises(StreamingQueryException):
        sinks.bounded_run([ok, bad], 600)
    assert time.monotonic() - began < 60 and not ok.isActive


def test_empty_files_and_markers_hold_no_alerts(spark, tmp_path):
    path = tmp_path / "gold"
    sinks.foreach_batch_anomaly(str(path))(micro_batch(spark, ("a", "X", 100.0), ("b", "X", 110.0)), 0)
    day = next(path.glob("alert_day=*"))
    (day / "batch_id=0" / "part-empty.parquet").touch()
    (day / "batch_id=1").mkdir()
    (path / "_SUCCESS").touch()
    assert rows(alert_file_scan(spark, str(path)), "batch_id", "trade_id") == [(0, "a"), (0, "b")]


def test_alert_files_as_a_stream(spark, tmp_path):
    path = str(tmp_path / "gold")
    deliver(tmp_path / "feed", 0, [trade(1, price=100.0), trade(2, price=110.0)])
    sinks.gold_sink(feed(spark, tmp_path / "feed"), path, str(tmp_path / "c"), trigger=None).awaitTermination()
    name = "alert_files"
    alert_file_stream(spark, path).writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    assert spark.table(name).where("file LIKE '%batch_id=0/%'").count() == 2


def config(tmp_path):
    return Config(root=str(tmp_path), trigger=None)


def test_medallion_run(spark, small_sf, tmp_path):
    wire = replay.wire_of(replay.trades_of(replay.events_stream(spark, small_sf)))
    cfg = config(tmp_path)
    got = {r["stage"]: (r["rows"], r["status"]) for r in medallion_run(spark, wire, cfg, 600).collect()}
    flagged = anomaly_self_join(replay.trades_of(replay.events(spark, small_sf))).count()
    assert got["bronze_raw_trades"] == (1000, "WRITTEN")
    assert got["gold_anomaly_alerts"] == (flagged, "WRITTEN")
    assert got["quality_gate"] == (0, "ALL_DQ_CHECKS_PASSED")
    assert got["alert_digest"][0] > 0 and got["alert_digest"][1] == "WRITTEN"


def test_medallion_run_fails_on_violations(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(1), trade(1), trade(2, price=-1.0)])
    with pytest.raises(DataQualityError) as e:
        medallion_run(spark, feed(spark, tmp_path / "feed"), config(tmp_path), 600)
    assert sorted(e.value.failures) == [("duplicate_ids", 1), ("negative_price", 1)]
    left = {r["stage"]: r["status"] for f in tmp_path.glob("*/run_report") for r in spark.read.parquet(str(f)).collect()}
    assert (left["quality_gate"], left["alert_digest"]) == ("DQ_FAILED", "SKIPPED")
    report = medallion_run(spark, feed(spark, tmp_path / "feed"), config(tmp_path), 600, strict=False)
    assert report.where("stage = 'quality_gate'").first()["status"] == "DQ_FAILED"


def test_a_run_without_alerts_has_an_empty_gold_table(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(1)])
    got = {r["stage"]: r["rows"] for r in medallion_run(spark, feed(spark, tmp_path / "feed"), config(tmp_path), 600).collect()}
    assert got["gold_anomaly_alerts"] == 0 and got["bronze_raw_trades"] == 1


def test_fresh_config_shares_no_path(tmp_path):
    cfg = Config(root=str(tmp_path))
    assert cfg.fresh().database != cfg.database and Config(root="r", catalog="c").fresh().database == "c"
    assert cfg.fresh().table_path("x") != cfg.table_path("x")
    assert cfg.fresh().checkpoint_path("x") != cfg.checkpoint_path("x")
