"""Alerts per event-time bucket from a stream."""

import pytest
from pyspark.sql import functions as F

from helpers import deliver, rows, trade
from tradeloom.operators.anomaly import anomaly_by_bucket
from tradeloom.sources.feed import resolve_payload, stream_source
from tradeloom.streaming import sinks

COLUMNS = ["bucket", "trade_id", "ticker", "round(window_avg_price, 6) AS average", "round(deviation_pct, 6) AS deviation", "direction"]


def feed(spark, folder):
    return resolve_payload(stream_source(spark, "text", {"path": str(folder), "maxFilesPerTrigger": "1"}))


def run(spark, tmp):
    query = sinks.bucket_alerts_sink(feed(spark, tmp / "feed"), str(tmp / "a"), str(tmp / "c"), trigger=None)
    query.awaitTermination()
    return query


def stored(spark, tmp):
    return spark.read.parquet(str(tmp / "a"))


def priced(n, start, seconds, busy=0.5):
    """Trades of a few tickers, one of which has most of them, a trade every ``seconds`` from minute ``start`` on."""
    out = []
    for i in range(n):
        at = start * 60 + i * seconds
        price = 100.0 + (i * 37 % 11 - 5) * (0.5 if i % 3 else 0.1)
        out.append(trade(f"{start}-{i}", "HOT" if i % 10 < 10 * busy else f"T{i % 3}", f"{int(at // 60):02d}:{at % 60:06.3f}", price=price))
    return out


def expected(spark, trades, until):
    wire = resolve_payload(spark.createDataFrame(trades, "trade_id string, ticker string, price double, quantity int, side string, "
                           "trade_type string, bid_price double, ask_price double, timestamp string, exchange string, source string"))
    found = anomaly_by_bucket(wire).where(F.col("bucket") + F.expr("INTERVAL 30 SECONDS") <= F.lit(until).cast("timestamp"))
    return rows(found.selectExpr(*COLUMNS))


def test_equals_the_batch_over_closed_buckets_across_restarts(spark, tmp_path):
    """Three deliveries, one of them in the middle of a bucket, and a restart before each."""
    parts = [priced(200, 0, 0.7), priced(200, 2, 0.7), priced(150, 5, 0.5)]
    parts[0] += [trade("none", None, "00:20", price=500.0), trade("notime", "T1", None, price=500.0)]
    for n, part in enumerate(parts):
        deliver(tmp_path / "feed", n, part)
        run(spark, tmp_path)
    # latest trade at 06:14.5, so the watermark is 06:04.5
    everything = [t for part in parts for t in part]
    want = expected(spark, everything, "2026-06-06 10:06:04.5")
    assert len(want) > 50 and rows(stored(spark, tmp_path).selectExpr(*COLUMNS)) == want


def test_late_trades_raise_no_alert(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(1, "A", "00:01", price=100.0), trade(2, "A", "00:02", price=110.0), trade(3, "A", "05:00")])
    run(spark, tmp_path)
    before = rows(stored(spark, tmp_path), "trade_id")
    deliver(tmp_path / "feed", 1, [trade(4, "A", "00:03", price=900.0), trade(5, "A", "09:00")])
    run(spark, tmp_path)
    assert before == [("t1",), ("t2",)] and rows(stored(spark, tmp_path), "trade_id") == before


def test_state_holds_open_buckets_only(spark, tmp_path):
    """However long the feed, state does not outgrow what is open, and no partition holds most of a busy ticker's trades."""
    sizes = []
    for n in range(5):
        deliver(tmp_path / "feed", n, priced(300, 3 * n, 0.5, busy=0.9))
        query = run(spark, tmp_path)
        joined = [op for op in query.recentProgress[-1].stateOperators if op.operatorName == "symmetricHashJoin"]
        sizes.append(sum(op.numRowsTotal for op in joined))
    # 60 trades make a bucket, and the watermark trails by 10 seconds
    assert max(sizes) <= 2 * 60 + 2 * 4 * 16, sizes


@pytest.mark.parametrize("trades", [[], [trade(1, None, "00:01"), trade(2, "A", None)]])
def test_feeds_without_usable_trades(spark, tmp_path, trades):
    deliver(tmp_path / "feed", 0, trades)
    deliver(tmp_path / "feed", 1, [trade(9, "B", "30:00")])
    run(spark, tmp_path)
    assert not list((tmp_path / "a").glob("*.parquet")) or stored(spark, tmp_path).count() == 0
