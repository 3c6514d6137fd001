"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of the tables and ``BENCH_CPUS`` the number of local cores.
Each query runs once to warm up and is then timed over ``BENCH_RUNS`` runs; the best counts.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from tradeloom import build_session
from tradeloom.plans.registry import QUERIES
from tradeloom.sources import replay

HEADLINE = [
    "vwap_1min", "vwap_5min", "vwap_dashboard", "vwap_latest", "vwap_reconcile", "vwap_1m_vs_5m",
    "anomaly_by_bucket", "anomaly_self_join", "anomaly_summary", "anomaly_timeline", "anomaly_rate",
    "ticker_stats", "totals", "source_distribution", "duplicate_ids", "pipeline_latency", "layer_counts",
    "batch_profile", "price_jump", "dq_checks", "dq_gate", "parse_trade_json", "normalize_vendor_trades",
    "ingest_throughput", "alert_summary", "alert_digest",
    "bronze_append", "silver_sink", "gold_sink", "fan_out",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("tradeloom-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="tradeloom-bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for _ in range(3):  # the first query would otherwise carry the start of the session
        timed(HEADLINE[0])
    seconds = {}
    for name in HEADLINE:
        timed(name)
        seconds[name] = round(min(timed(name) for _ in range(runs)), 3)

    events = replay.events(spark, sf_dir).count()
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_of_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1).rstrip(".")) if found else sf_dir,
        "events": events,
        "vwap_1min_trades_per_sec": round(events / seconds["vwap_1min"]),
        "silver_stream_trades_per_sec": round(events / seconds["silver_sink"]),
        "all_streams_trades_per_sec": round(events / seconds["fan_out"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
