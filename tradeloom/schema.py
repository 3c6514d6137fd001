"""Schemas of the feed and of the stored tables, and the fixed values that go with them."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)

# Names, types and order are fixed by the wire contract. The fields that may not be missing are marked so; JSON parsing
# ignores the mark, so the quality checks enforce it.
WIRE = StructType([
    StructField("trade_id", StringType(), nullable=False),
    StructField("ticker", StringType(), nullable=False),
    StructField("price", DoubleType(), nullable=False),
    StructField("quantity", IntegerType(), nullable=False),
    StructField("side", StringType(), nullable=False),
    StructField("trade_type", StringType(), nullable=False),
    StructField("bid_price", DoubleType()),
    StructField("ask_price", DoubleType()),
    StructField("timestamp", StringType(), nullable=False),
    StructField("exchange", StringType()),
    StructField("source", StringType()),
])

# A vendor message, fixed by the vendor. Volume is read as the text of the number, so that 1.5 and 1 stay apart.
VENDOR_MESSAGE = StructType([
    StructField("type", StringType()),
    StructField("data", ArrayType(StructType([
        StructField("s", StringType()),
        StructField("p", DoubleType()),
        StructField("v", StringType()),
        StructField("t", LongType()),
    ]))),
])

BRONZE_PARTITIONS = ["year", "month", "day", "ticker"]

# Stored tables: the columns are fixed by the tables' readers.
BRONZE = StructType([
    StructField("trade_id", StringType()),
    StructField("price", DoubleType()),
    StructField("quantity", IntegerType()),
    StructField("side", StringType()),
    StructField("trade_type", StringType()),
    StructField("bid_price", DoubleType()),
    StructField("ask_price", DoubleType()),
    StructField("exchange", StringType()),
    StructField("source", StringType()),
    StructField("event_time", TimestampType()),
    StructField("ingested_at", TimestampType()),
    StructField("year", IntegerType()),
    StructField("month", IntegerType()),
    StructField("day", IntegerType()),
    StructField("ticker", StringType()),
])

SILVER = StructType([
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("ticker", StringType()),
    StructField("vwap", DoubleType()),
    StructField("total_volume", LongType()),
    StructField("trade_count", LongType()),
    StructField("low_price", DoubleType()),
    StructField("high_price", DoubleType()),
    StructField("buy_ratio", DoubleType()),
    StructField("source", StringType()),
    StructField("computed_at", TimestampType()),
])

# Own table: what windows of any length are merged from.
PARTIALS = StructType([
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("ticker", StringType()),
    StructField("source", StringType()),
    StructField("notional", DoubleType()),
    StructField("volume", LongType()),
    StructField("trades", LongType()),
    StructField("buys", LongType()),
    StructField("low", DoubleType()),
    StructField("high", DoubleType()),
])

# The day and the number of the micro-batch are this package's own; the rest is fixed by the readers.
GOLD = StructType([
    StructField("trade_id", StringType()),
    StructField("ticker", StringType()),
    StructField("price", DoubleType()),
    StructField("quantity", IntegerType()),
    StructField("side", StringType()),
    StructField("event_time", TimestampType()),
    StructField("source", StringType()),
    StructField("window_avg_price", DoubleType()),
    StructField("deviation_pct", DoubleType()),
    StructField("direction", StringType()),
    StructField("detected_at", TimestampType()),
    StructField("alert_day", DateType()),
    StructField("batch_id", LongType()),
])

# name -> (schema, partition columns)
TABLES = {
    "bronze_raw_trades": (BRONZE, BRONZE_PARTITIONS),
    "silver_vwap_1min": (SILVER, []),
    "silver_vwap_5min": (SILVER, []),
    "gold_anomaly_alerts": (GOLD, ["alert_day", "batch_id"]),
}
# Compacted tables keep these levels only, so that files of several micro-batches can merge.
COMPACTED_PARTITIONS = {"gold_anomaly_alerts": ["alert_day"]}

# Tickers and sides of the feed, what its vendor adapter writes, and the status of a passed gate.
REFERENCE_TICKERS = (
    "AAPL", "MSFT", "NVDA", "GOOGL", "AMZN", "META", "TSLA", "BRK-B", "JPM", "JNJ", "V", "PG", "UNH",
    "HD", "MA", "DIS", "PYPL", "BAC", "NFLX", "ADBE", "CRM", "INTC", "VZ", "CMCSA", "PEP",
)
SIDES = ("buy", "sell", "unknown")
VENDOR_ID_PREFIX = "fh"
VENDOR_EXCHANGE = "Finnhub"
VENDOR_SOURCE = "finnhub_live"
GATE_PASSED = "ALL_DQ_CHECKS_PASSED"
GATE_FAILED = "DQ_FAILED"
