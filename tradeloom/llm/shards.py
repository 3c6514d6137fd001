"""Jump consistent hashing: rows to shards without a ring table.

A key walks through a series of ever longer jumps; the last landing below the number of shards is its
shard. Adding one shard moves only those rows whose next jump lands on it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.frames import fresh_name, keep, partitions

#: Fixed values of the published algorithm (Lamping and Veach, 2014).
MULTIPLIER = np.uint64(2862933555777941757)
JUMP_SPAN = float(1 << 31)

ROWS_PER_PARTITION = 1_000_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key, all keys stepping together."""
    state = keys.astype(np.uint64)
    landed = np.zeros(len(state), np.int64)
    following = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        landed[moving] = following[moving]
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        stride = JUMP_SPAN / ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        following[moving] = ((landed[moving] + 1) * stride).astype(np.int64)
        moving = moving[following[moving] < shards]
    return landed.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a bigint key; a null key counts as 0."""
    if shards < 1:
        raise ValueError("there must be at least one shard")

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards))

    return place(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def assign_shards(df: DataFrame, key: str, shards: int, into: str = "shard") -> DataFrame:
    """All columns of ``df`` and the shard of its row, in a narrow pass.

    Equal keys share a shard and a null key counts as 0. An empty frame stays empty. Other columns are
    not looked at; ``into`` replaces a column of that name.
    """
    return df.withColumn(into, shard_of(F.col(key), shards))


def number_slots(df: DataFrame, shard: str, order: str, into: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in ascending ``order`` (nulls first).

    Rows are spread by range of (order, row), so neither a large shard nor a repeated key meets in one
    task: each range counts its rows by shard, the counts are summed along the ranges, and a row adds its
    place in its own range. Rows of equal ``order`` are numbered in any order.
    """
    row, part = fresh_name(df, "_row"), fresh_name(df, "_part")
    kept = keep(df.withColumn(row, F.monotonically_increasing_id()))
    ranges = max(partitions(df.sparkSession), kept.count() // ROWS_PER_PARTITION + 1)
    spread = keep(kept.repartitionByRange(ranges, order, row).withColumn(part, F.spark_partition_id()))
    before, counted, in_shard, in_part = (fresh_name(df, c) for c in ("_before", "_counted", "_of_shard", "_of_part"))
    counts = spread.groupBy(F.col(shard).alias(in_shard), F.col(part).alias(in_part)).agg(
        F.count(F.lit(1)).alias(counted))
    earlier = Window.partitionBy(in_shard).orderBy(in_part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(in_shard, in_part, F.coalesce(F.sum(counted).over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy(part, shard).orderBy(order, row)
    return (
        spread.withColumn(into, F.row_number().over(inside) - 1)
        .join(starts, (F.col(part) == F.col(in_part)) & F.col(shard).eqNullSafe(F.col(in_shard)))
        .withColumn(into, F.col(into) + F.col(before))
        .drop(row, part, before, in_shard, in_part)
    )
