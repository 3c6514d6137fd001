"""Stored tables: reading, registering, describing, compacting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.config import Config
from tradeloom.schema import COMPACTED_PARTITIONS, TABLES
from tradeloom.sources.commits import commits, file_system, has_commits, only_committed


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A stored table with its declared schema; partition values are not left to inference, so a ticker
    of digits stays text. Of a table that keeps commits, the files that are committed."""
    return only_committed(spark, path, spark.read.schema(TABLES[table][0]).parquet(path))


def partition_pruned_scan(
    spark: SparkSession, table: str, year: int, month: int, day: int, ticker: str | None = None
) -> DataFrame:
    """One day, or one day of one ticker, of a registered bronze table."""
    df = spark.table(table).where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
    return df if ticker is None else df.where(F.col("ticker") == ticker)


def alert_file_scan(spark: SparkSession, path: str, table: str = "gold_anomaly_alerts") -> DataFrame:
    """All committed alerts with the file they are in. Folder markers and empty files hold no rows."""
    stored = spark.read.schema(TABLES[table][0]).parquet(path).where(F.col("_metadata.file_size") > 0)
    named = stored.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata"))
    return only_committed(spark, path, named).drop("_metadata")


def alert_file_stream(spark: SparkSession, path: str, table: str = "gold_anomaly_alerts") -> DataFrame:
    """The same for files as they arrive, each of them whole; it may come a moment before its commit."""
    stream = spark.readStream.schema(TABLES[table][0]).parquet(path)
    return stream.where(F.col("_metadata.file_size") > 0).withColumn("file", F.col("_metadata.file_path"))


def footer_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows of each stored table, (layer, record_count), without reading a column: from the footers of its Parquet files,
    or from its commits where it keeps some. ``paths`` names the tables and their folders; one that is not there has none.

    Aggregates reach the footers through the second version of Spark's file reader only, so the counts come from a session
    of their own that has it; the given session's settings stay.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = []
    for table, path in paths.items():
        if not folder_exists(spark, path):
            found = session.range(1).select(F.lit(0).cast("long").alias("record_count"))
        elif has_commits(spark, path):
            found = commits(session, path).agg(F.coalesce(F.sum("flagged"), F.lit(0)).alias("record_count"))
        else:
            found = session.read.schema(TABLES[table][0]).parquet(path).agg(F.count("*").alias("record_count"))
        counts.append(found.select(F.lit(table).alias("layer"), "record_count"))
    return reduce(DataFrame.unionByName, counts)


def table_register(spark: SparkSession, cfg: Config) -> list[str]:
    """Register the tables of a run as external tables and load the partitions found on disk.

    A name that already stands for another folder is an error: it is never moved under its readers.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {cfg.database} LOCATION '{cfg.table_path('catalog')}'")
    for table, (_, partitions) in TABLES.items():
        _declare(spark, f"{cfg.database}.{table}", table, partitions, _qualified(spark, cfg.table_path(table)))
    return [f"{cfg.database}.{table}" for table in TABLES]


def table_repoint(spark: SparkSession, cfg: Config, table: str, target: str) -> str:
    """Let a run's table stand for its compacted copy in ``target`` from now on. The old files stay where they are."""
    name = f"{cfg.database}.{table}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    partitions = COMPACTED_PARTITIONS.get(table, TABLES[table][1])
    _declare(spark, name, table, partitions, _qualified(spark, target))
    return name


def _declare(spark: SparkSession, name: str, table: str, partitions: list[str], path: str) -> None:
    if not spark.catalog.tableExists(name):
        by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        # Declared at a place without files, then moved: where a streaming sink has left its log, Spark would drop the
        # declared columns and guess the types of partition values, so that the ticker 007 would become 7.
        spark.sql(f"CREATE TABLE {name} ({TABLES[table][0].toDDL()}) USING parquet {by} LOCATION '{path}.declared'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    if _location(spark, name) != path:
        raise ValueError(f"{name} is registered for {_location(spark, name)}, not for {path}")
    # A run without alerts leaves no gold folder to look into; a streaming sink's log knows its own partitions.
    if partitions and folder_exists(spark, path) and not folder_exists(spark, f"{path}/_spark_metadata"):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]


def _qualified(spark: SparkSession, path: str) -> str:
    fs, folder = file_system(spark, path)
    return fs.makeQualified(folder).toString()


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = file_system(spark, path)
    return fs.exists(folder)


def table_describe(spark: SparkSession, name: str) -> DataFrame:
    """Columns of a registered table in order, with type, partition mark and the table's location."""
    location = _location(spark, name)
    partitions = {c.name for c in spark.catalog.listColumns(name) if c.isPartition}
    rows = [
        (i, f.name, f.dataType.simpleString(), f.name in partitions, name, location)
        for i, f in enumerate(spark.table(name).schema.fields)
    ]
    return spark.createDataFrame(
        rows, "position int, col_name string, data_type string, is_partition boolean, table_name string, location string"
    )


def compact_table(spark: SparkSession, table: str, source: str, target: str) -> DataFrame:
    """Rewrite a stored table into few files, at a new path.

    The rebalance step merges the many small pieces that streams leave and splits what is large, to about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each, within the table's partitions; those of gold are then the
    days, so that micro-batches merge. ``table_repoint`` lets the table's name stand for the result.
    """
    partitions = COMPACTED_PARTITIONS.get(table, TABLES[table][1])
    df = read_table(spark, source, table).hint("rebalance", *partitions)
    df.write.partitionBy(*partitions).parquet(target)
    return read_table(spark, target, table)


def compact_bronze(spark: SparkSession, source: str, target: str) -> DataFrame:
    return compact_table(spark, "bronze_raw_trades", source, target)
