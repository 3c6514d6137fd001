"""Counts and totals over the stored trades."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ticker_stats(bronze: DataFrame) -> DataFrame:
    """Trades, average price and time span per ticker."""
    return (
        bronze.groupBy("ticker")
        .agg(
            F.count("*").alias("trade_count"),
            F.round(F.avg("price"), 2).alias("avg_price"),
            F.min("event_time").alias("first_trade"),
            F.max("event_time").alias("last_trade"),
        )
        .orderBy(F.desc("trade_count"), F.asc_nulls_last("ticker"))
    )


def totals(bronze: DataFrame) -> DataFrame:
    """Size and time span of the table, in one row.

    Two distinct counts in one aggregate would copy every row per count, so the rows are first
    reduced to one per (ticker, source).
    """
    pairs = bronze.groupBy("ticker", "source").agg(
        F.count("*").alias("n"), F.min("event_time").alias("first"), F.max("event_time").alias("last")
    )
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count_distinct("ticker").alias("unique_tickers"),
        F.count_distinct("source").alias("unique_sources"),
        F.min("first").alias("earliest_trade"),
        F.max("last").alias("latest_trade"),
    )


def source_distribution(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("source").agg(F.count("*").alias("count"))


def duplicate_ids(bronze: DataFrame) -> DataFrame:
    """Ids seen more than once. Copies of one id collapse within each task before the shuffle."""
    return bronze.groupBy("trade_id").agg(F.count("*").alias("cnt")).where("cnt > 1")


def surplus_ids() -> Column:
    """Rows beyond the first of their id; every row without an id counts as one."""
    return F.count("*") - F.count_distinct("trade_id")


def duplicate_count(bronze: DataFrame) -> DataFrame:
    return bronze.agg(surplus_ids().alias("duplicates"))


def pipeline_latency(bronze: DataFrame) -> DataFrame:
    """Mean seconds from trade to ingest, fractions kept."""
    micros = F.unix_micros("ingested_at") - F.unix_micros("event_time")
    return bronze.agg(F.round(F.avg(micros) / 1e6, 3).alias("avg_latency_seconds"))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer."""
    counts = [df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("layer"), "record_count")
              for name, df in layers.items()]
    return reduce(DataFrame.unionByName, counts)


def distinct_tickers(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("ticker").alias("distinct_tickers"))


def top_tickers(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` tickers with the most trades."""
    return df.groupBy("ticker").agg(F.count("*").alias("trades")).orderBy(F.desc("trades"), F.asc_nulls_last("ticker")).limit(n)


def batch_profile(df: DataFrame, top: int = 10) -> DataFrame:
    """What a batch holds, as (section, name, trades): rows, distinct tickers, sources, busiest tickers.

    All sections roll up one count per (ticker, source). Each of them uses that count, so Spark runs
    the scan and the exchange below it once and reuses them.
    """
    pairs = df.groupBy("ticker", "source").agg(F.count("*").alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    none = F.lit(None).cast("string")
    by_ticker = pairs.groupBy("ticker").agg(rows.alias("trades"))
    sections = [
        pairs.agg(rows.alias("trades")).select(F.lit("rows").alias("section"), none.alias("name"), "trades"),
        by_ticker.agg(F.count_if(F.col("ticker").isNotNull() & (F.col("trades") > 0)).alias("trades")).select(
            F.lit("distinct_tickers").alias("section"), none.alias("name"), "trades"
        ),
        pairs.groupBy("source").agg(rows.alias("trades")).select(
            F.lit("source").alias("section"), F.col("source").alias("name"), "trades"
        ),
        by_ticker.orderBy(F.desc("trades"), F.asc_nulls_last("ticker")).limit(top).select(
            F.lit("top_ticker").alias("section"), F.col("ticker").alias("name"), "trades"
        ),
    ]
    return reduce(DataFrame.unionByName, sections)


def batch_sample(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows of a batch, for a look at their shape."""
    return df.limit(n)


def ingest_throughput(
    raw: DataFrame, payload_col: str, ts: str = "event_time", per: str = "1 minute", limit_bytes_per_sec: int = 1024 * 1024
) -> DataFrame:
    """Records and payload bytes per interval, and the share of the feed's byte limit they use."""
    slots = raw.groupBy(F.window(ts, per)).agg(
        F.count("*").alias("records"), F.sum(F.octet_length(payload_col)).alias("bytes")
    )
    start, end = F.col("window.start"), F.col("window.end")
    seconds = F.unix_seconds(end) - F.unix_seconds(start)
    return slots.select(
        start.alias("window_start"),
        "records",
        "bytes",
        F.round(F.col("bytes") / (seconds * limit_bytes_per_sec) * 100, 4).alias("limit_pct"),
    )
