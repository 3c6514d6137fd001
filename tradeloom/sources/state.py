"""What a stopped stream of windows still holds: the windows that the watermark has not closed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.operators.vwap import merge_partials
from tradeloom.schema import PARTIALS

# The order of a window's running values in state: with the source as a key (a first step), and without.
BY_SOURCE = ("notional", "volume", "trades", "buys", "low", "high")
BY_WINDOW = ("notional", "volume", "trades", "low", "high", "buys", "source")


def open_partials(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The partial results in the state of a stream of windows (``silver_sink``, ``partials_sink``), as its last micro-batch
    left them. Where one stateful step follows another, a window lies in the one or the other."""
    steps = spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct().collect()  # one or two
    found = []
    for step in steps:
        state = spark.read.format("statestore").option("operatorId", step["operatorId"]).load(checkpoint)
        by_source = "source" in state.schema["key"].dataType.names
        names = BY_SOURCE if by_source else BY_WINDOW
        # Values of one kind share a name in state, so they are named by their order.
        values = F.col("value").cast(T.StructType([T.StructField(n, PARTIALS[n].dataType) for n in names]))
        rows = state.select("key", values.alias("value"))
        source = F.col("key.source") if by_source else F.col("value.source")
        found.append(rows.select(
            F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"), F.col("key.ticker").alias("ticker"),
            source.alias("source"), *[F.col(f"value.{n}").alias(n) for n in PARTIALS.names[4:]]))
    return reduce(DataFrame.unionByName, found)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows still open when a stream stopped, with what they hold so far, in the columns of ``window_flatten`` but the
    stamp. Together with the stored ones they are all windows of the trades read, but for those dropped as late."""
    merged = merge_partials(open_partials(spark, checkpoint))
    return merged.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         *[c for c in merged.columns if c != "window"])
