"""Trades replayed from the given ``events`` table: the input of the registered queries and of the tests.

Each event becomes one trade, 50 ms after the one before it. The mapping is row-wise, so it works on
batch and streaming input and grows with the table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

START = datetime(2026, 6, 6, 23, 56)  # so that the trades of all but the smallest tables go on past midnight
START_MICROS = 1_780_790_160_000_000  # START in UTC
STEP_MICROS = 50_000

# The given table's columns.
EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because a plain path must be a folder and the table may be a single file.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def event_micros() -> Column:
    return F.col("event_id") * STEP_MICROS + F.lit(START_MICROS)


def trades_of(df: DataFrame) -> DataFrame:
    """Trades with typed event time and ingest time."""
    n = F.col("user_id") % 25
    base = n * 15 + 100
    sign = F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1)
    price = F.floor(base * (1 + sign * F.col("value") / 15000.0) * 100) / 100
    rows = df.select(
        F.concat(F.lit("tr-"), F.col("event_id").cast("string")).alias("trade_id"),
        F.concat(F.lit("TK"), F.lpad(n.cast("string"), 2, "0")).alias("ticker"),
        price.alias("price"),
        (F.col("event_id") * 37 % 500 + 1).cast("int").alias("quantity"),
        F.when(F.col("event_id") % 3 == 0, "sell").otherwise("buy").alias("side"),
        F.when(F.col("event_id") % 2 == 0, "limit").otherwise("market").alias("trade_type"),
        F.timestamp_micros(event_micros()).alias("event_time"),
        F.timestamp_micros(event_micros() + F.col("event_id") % 30000 * 1000).alias("ingested_at"),
        "event_type",
        "value",
    )
    return rows.select(
        "trade_id", "ticker", "price", "quantity", "side", "trade_type",
        (F.col("price") - 0.02).alias("bid_price"),
        (F.col("price") + 0.02).alias("ask_price"),
        F.lit("TEST").alias("exchange"),
        F.when(F.col("event_type") == "view", "replay-a").when(F.col("event_type") == "click", "replay-b")
        .otherwise("replay-c").alias("source"),
        "event_time", "ingested_at", "event_type", "value",
    )


def wire_of(trades: DataFrame) -> DataFrame:
    """The same trades as wire rows, event time as ISO text."""
    return trades.select(
        "trade_id", "ticker", "price", "quantity", "side", "trade_type", "bid_price", "ask_price",
        F.date_format("event_time", ISO).alias("timestamp"), "exchange", "source",
    )


def dirtied(trades: DataFrame, as_of: datetime) -> DataFrame:
    """All trades, some spoiled according to their ``value``: missing, wrong, future and repeated fields."""
    v = F.col("value")
    kind = F.col("event_type")
    future = F.lit(str(as_of)).cast("timestamp") + F.expr("INTERVAL 6 MINUTES")
    return trades.select(
        F.when(v.between(300, 340), F.lit(None)).when(v.between(200, 205), "tr-again")
        .otherwise(F.col("trade_id")).alias("trade_id"),
        F.when(v >= 360, F.lit(None)).otherwise(F.col("ticker")).alias("ticker"),
        F.when((v < 1) & (kind == "error"), -F.col("price")).when((v < 1) & (kind == "click"), 0.0)
        .otherwise(F.col("price")).alias("price"),
        F.when(v.between(1, 2), 0).otherwise(F.col("quantity")).alias("quantity"),
        F.when(v.between(2, 3) & (kind == "signup"), "hold").when(v.between(2, 3) & (kind == "view"), F.lit(None))
        .otherwise(F.col("side")).alias("side"),
        "trade_type", "bid_price", "ask_price", "exchange", "source",
        F.when(v.between(250, 260), F.lit(None)).when(v.between(260, 270), future)
        .otherwise(F.col("event_time")).alias("event_time"),
        "ingested_at",
    )
