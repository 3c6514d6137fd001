import pytest

from helpers import deliver, rows, trade
from tradeloom.config import Config
from tradeloom.plans import registry
from tradeloom.schema import TABLES
from tradeloom.sources import tables
from tradeloom.sources.feed import resolve_payload, stream_source
from tradeloom.streaming import sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small_sf):
    return registry._stored_batch(spark, small_sf, *TABLES)


def test_scan_of_one_day_and_ticker_is_pruned(spark, stored):
    df = tables.partition_pruned_scan(spark, f"{stored.database}.bronze_raw_trades", 2026, 6, 6, "TK07")
    text = plan(df)
    scanned = text[text.index("PartitionFilters"):]
    for column in ("year", "month", "day", "ticker"):
        assert column in scanned.split("PushedFilters")[0]
    assert df.count() > 0
    assert tables.partition_pruned_scan(spark, f"{stored.database}.bronze_raw_trades", 2026, 6, 7).count() == 0


def test_only_needed_columns_are_read(spark, stored):
    from tradeloom.operators.stats import source_distribution

    text = plan(source_distribution(spark.table(f"{stored.database}.bronze_raw_trades")))
    assert "ReadSchema: struct<source:string>" in text


def test_a_name_is_not_moved_to_another_run(spark, stored):
    other = Config(root=stored.root, catalog=stored.database)
    with pytest.raises(ValueError, match="is registered for"):
        tables.table_register(spark, other)


def test_describe(spark, stored):
    got = tables.table_describe(spark, f"{stored.database}.bronze_raw_trades").orderBy("position").collect()
    assert [r["col_name"] for r in got if r["is_partition"]] == ["year", "month", "day", "ticker"]
    assert got[0]["location"].endswith(stored.table_path("bronze_raw_trades").lstrip("/"))


def test_describe_a_streamed_table(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(1)])
    cfg = Config(root=str(tmp_path), trigger=None, catalog="db_streamed")
    wire = resolve_payload(stream_source(spark, "text", {"path": str(tmp_path / "feed")}))
    sinks.bounded_run(sinks.fan_out(wire, cfg), 600)
    assert tables.table_register(spark, cfg) == tables.table_register(spark, cfg)
    got = tables.table_describe(spark, "db_streamed.bronze_raw_trades").collect()
    assert {r["col_name"] for r in got if r["is_partition"]} == {"year", "month", "day", "ticker"}
    assert [(r["col_name"], r["data_type"]) for r in got if r["col_name"] == "ticker"] == [("ticker", "string")]
    assert "MetadataLogFileIndex" in plan(tables.partition_pruned_scan(spark, "db_streamed.bronze_raw_trades", 2026, 6, 6, "A"))


def test_tickers_in_partitions(spark, tmp_path):
    """Digits stay text, a hyphen is kept, and missing or empty tickers read back as NULL."""
    given = ["007", "BRK-B", "A/B C", None, ""]
    deliver(tmp_path / "feed", 0, [trade(i, t) for i, t in enumerate(given)])
    wire = resolve_payload(stream_source(spark, "text", {"path": str(tmp_path / "feed")}))
    sinks.bronze_append(wire, str(tmp_path / "b"), str(tmp_path / "c"), None).awaitTermination()
    got = tables.read_table(spark, str(tmp_path / "b"), "bronze_raw_trades")
    assert {r["trade_id"]: r["ticker"] for r in got.collect()} == {
        "t0": "007", "t1": "BRK-B", "t2": "A/B C", "t3": None, "t4": None
    }


def test_tickers_of_a_streamed_table_in_the_catalog(spark, tmp_path):
    deliver(tmp_path / "feed", 0, [trade(0, "000"), trade(1, "007", price=120.0), trade(2, "007", price=100.0)])
    cfg = Config(root=str(tmp_path), trigger=None)
    wire = resolve_payload(stream_source(spark, "text", {"path": str(tmp_path / "feed")}))
    sinks.bounded_run(sinks.fan_out(wire, cfg), 600)
    tables.table_register(spark, cfg)
    stored = spark.table(f"{cfg.database}.bronze_raw_trades")
    assert stored.schema["ticker"].dataType.simpleString() == "string"
    assert {r["ticker"] for r in stored.collect()} == {"000", "007"}
    assert tables.partition_pruned_scan(spark, f"{cfg.database}.bronze_raw_trades", 2026, 6, 6, "007").count() == 2
    assert rows(spark.table(f"{cfg.database}.gold_anomaly_alerts"), "ticker") == [("007",)] * 2


def test_compaction_merges_micro_batches_and_takes_the_name(spark, tmp_path):
    for n in range(4):
        deliver(tmp_path / "feed", n, [trade(f"{n}a", "A", price=100.0), trade(f"{n}b", "A", price=120.0)])
    cfg = Config(root=str(tmp_path), trigger=None)
    options = {"path": str(tmp_path / "feed"), "maxFilesPerTrigger": "1"}
    sinks.bounded_run(sinks.fan_out(resolve_payload(stream_source(spark, "text", options)), cfg), 600)
    tables.table_register(spark, cfg)
    for table, files in (("gold_anomaly_alerts", 1), ("bronze_raw_trades", 1)):
        before = spark.table(f"{cfg.database}.{table}")
        kept, many = rows(before, "trade_id"), len(before.inputFiles())
        target = str(tmp_path / f"{table}_compact")
        tables.compact_table(spark, table, cfg.table_path(table), target)
        after = spark.table(tables.table_repoint(spark, cfg, table, target))
        assert (rows(after, "trade_id"), len(after.inputFiles())) == (kept, files) and many >= 4
        assert after.schema == before.schema or set(after.columns) == set(before.columns)


def test_new_partitions_are_found_when_registered_again(spark, stored):
    name = f"{stored.database}.gold_anomaly_alerts"
    before = spark.table(name).count()
    extra = spark.table(name).drop("batch_id", "alert_day")
    extra.write.parquet(f"{stored.table_path('gold_anomaly_alerts')}/alert_day=2026-06-08/batch_id=99")
    tables.table_register(spark, stored)
    assert spark.table(name).count() == 2 * before


def test_compaction_keeps_rows_and_leaves_fewer_files(spark, small_sf, stored, tmp_path):
    source = str(tmp_path / "many")
    registry.bronze(spark, small_sf).repartition(8).write.partitionBy("year", "month", "day", "ticker").parquet(source)
    compact = tables.compact_bronze(spark, source, str(tmp_path / "few"))
    before = tables.read_table(spark, source, "bronze_raw_trades")
    assert rows(compact, "trade_id", "ticker", "price") == rows(before, "trade_id", "ticker", "price")
    tickers = before.select("ticker").distinct().count()
    assert len(compact.inputFiles()) == tickers
    assert len(before.inputFiles()) > 4 * tickers


def test_compaction_of_an_unpartitioned_table(spark, small_sf, tmp_path):
    source = str(tmp_path / "many")
    registry.silver(spark, small_sf).repartition(20).write.parquet(source)
    compact = tables.compact_table(spark, "silver_vwap_1min", source, str(tmp_path / "one"))
    assert len(compact.inputFiles()) == 1
    assert rows(compact, "ticker", "vwap") == rows(tables.read_table(spark, source, "silver_vwap_1min"), "ticker", "vwap")
