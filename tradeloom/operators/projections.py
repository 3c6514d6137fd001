"""Row-wise steps between the layers; all of them work on batch and streaming input."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import notional
from tradeloom.schema import BRONZE


def clock(as_of: datetime | None) -> Column:
    """The current time, or a given one where a result must be repeatable."""
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def typed_event_time(df: DataFrame) -> Column:
    """Event time of a wire row (text that may not parse) or of a row that has it typed already."""
    return F.col("event_time") if "event_time" in df.columns else F.try_to_timestamp("timestamp")


def bronze_enrich(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The stored table's columns, in its order and types: the wire's fields, typed times, and the event's date.

    A row of a feed that was ingested before keeps its ingest time.
    """
    at = typed_event_time(df)
    computed = {
        "event_time": at,
        "ingested_at": F.col("ingested_at") if "ingested_at" in df.columns else clock(as_of),
        "year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at),
    }
    return df.select(*[computed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in BRONZE.fields])


def silver_project(df: DataFrame) -> DataFrame:
    """The columns a VWAP needs."""
    return df.select(
        "ticker",
        "price",
        "quantity",
        notional(F.col("price"), F.col("quantity")).alias("notional"),
        "side",
        "source",
        typed_event_time(df).alias("event_time"),
    )


def gold_project(df: DataFrame) -> DataFrame:
    """The columns an alert carries."""
    return df.select(
        "trade_id", "ticker", "price", "quantity", "side", "source", typed_event_time(df).alias("event_time")
    )


def window_flatten(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Replace the window struct by its two ends and stamp the row."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
        clock(as_of).alias("computed_at"),
    )
