"""Vendor messages mapped to the wire record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.schema import VENDOR_EXCHANGE, VENDOR_ID_PREFIX, VENDOR_MESSAGE, VENDOR_SOURCE


def normalize_vendor_trades(df: DataFrame, col: str) -> DataFrame:
    """One wire row per item of the ``trade`` messages in ``col``; other message types are ignored.

    ``quantity`` is NULL when the volume is not a whole number within INT, however it is written: 100, 100.0 and 1e2 are
    the same; ``quantity_raw`` keeps it.
    Items of one symbol and millisecond share an id, so ``item`` gives the place in the message.
    """
    message = F.from_json(F.col(col).cast("string"), VENDOR_MESSAGE)
    # The outer form keeps Spark from testing the array below the parse, which would parse twice.
    items = (
        df.select(message.alias("m"))
        .select(F.when(F.col("m.type") == "trade", F.col("m.data")).alias("items"))
        .select(F.posexplode_outer("items").alias("item", "d"))
        .where(F.col("item").isNotNull())
    )
    volume = F.col("d.v").try_cast("double")
    return items.select(
        F.concat_ws("-", F.lit(VENDOR_ID_PREFIX), F.col("d.t").cast("string"), "d.s").alias("trade_id"),
        F.col("d.s").alias("ticker"),
        F.col("d.p").alias("price"),
        F.when(F.floor(volume) == volume, volume.try_cast("int")).alias("quantity"),
        F.lit("unknown").alias("side"),
        F.lit("market").alias("trade_type"),
        F.lit(None).cast("double").alias("bid_price"),
        F.lit(None).cast("double").alias("ask_price"),
        # The offset is part of the text, so any session zone names the same instant.
        F.date_format(F.timestamp_millis("d.t"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
        F.lit(VENDOR_EXCHANGE).alias("exchange"),
        F.lit(VENDOR_SOURCE).alias("source"),
        volume.alias("quantity_raw"),
        "item",
    )
