"""One run of the whole pipeline: streams, tables, gate, digest, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.config import Config
from tradeloom.operators.alerts import alert_digest
from tradeloom.operators.quality import GATE, DataQualityError, dq_checks
from tradeloom.operators.stats import layer_counts
from tradeloom.schema import GATE_FAILED, GATE_PASSED, TABLES
from tradeloom.sources.tables import alert_file_scan, folder_exists, table_register
from tradeloom.streaming.sinks import bounded_run, fan_out


def medallion_run(
    spark: SparkSession, wire: DataFrame, cfg: Config, seconds: float = 600, strict: bool = True
) -> DataFrame:
    """Run the four streams, register their tables, check bronze, digest the alerts, and report.

    The report, (run_id, stage, rows, status), is stored as the run's table ``run_report`` before anything is raised.
    With violations ``strict`` makes no digest and raises ``DataQualityError``; otherwise the gate's row says what it
    found and the run goes on.
    """
    bounded_run(fan_out(wire, cfg), seconds)
    table_register(spark, cfg)
    found = dq_checks(spark.table(f"{cfg.database}.bronze_raw_trades"), GATE).collect()  # one row per check
    failures = [(r["check_name"], r["violations"]) for r in found if r["violations"] > 0]

    def stage(name: str, rows: Column, status: str) -> DataFrame:
        return spark.range(1).select(F.lit(name).alias("stage"), rows.cast("long").alias("rows"), F.lit(status).alias("status"))

    gate = stage("quality_gate", F.lit(sum(n for _, n in failures)), GATE_FAILED if failures else GATE_PASSED)
    digests = cfg.table_path("alert_digests")
    if failures and strict:
        last = stage("alert_digest", F.lit(0), "SKIPPED")
    else:
        files = alert_file_scan(spark, cfg.table_path("gold_anomaly_alerts")) if folder_exists(spark, cfg.table_path("gold_anomaly_alerts")) else (
            spark.table(f"{cfg.database}.gold_anomaly_alerts").withColumn("file", F.lit(None).cast("string")))
        alert_digest(files, "file", cfg.anomaly_threshold).hint("rebalance").write.parquet(digests)
        last = spark.read.schema("file string, ticker string, subject string, body string").parquet(digests).agg(
            F.count("ticker").alias("rows")).select(F.lit("alert_digest").alias("stage"), "rows", F.lit("WRITTEN").alias("status"))
    layers = layer_counts({t: spark.table(f"{cfg.database}.{t}") for t in TABLES}).select(
        F.col("layer").alias("stage"), F.col("record_count").alias("rows"), F.lit("WRITTEN").alias("status"))
    report = layers.unionByName(gate).unionByName(last).select(F.lit(cfg.run_id).alias("run_id"), "stage", "rows", "status")
    report.coalesce(1).write.parquet(cfg.table_path("run_report"))
    if failures and strict:
        raise DataQualityError(failures)
    return spark.read.schema(report.schema).parquet(cfg.table_path("run_report"))
