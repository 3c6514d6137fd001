"""Joining every row with a statistic of its group, whatever the sizes of the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.config import shared_dir

BROADCAST_BYTES = 32 * 1024 * 1024
HOT_GROUPS = 50_000


def join_group_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: list[str],
    size: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_groups: int = HOT_GROUPS,
    held: list[DataFrame] | None = None,
) -> DataFrame:
    """Inner-join ``rows`` with ``stats``, one row per group, where column ``size`` counts the group's rows.

    ``stats`` is computed once and measured: written to the shared folder, or, where the caller gives a list ``held``,
    kept by the executors and added to the list, for the caller to release. If it is small, it is broadcast and ``rows`` do not move.
    Otherwise both sides are shuffled, with the large groups spread over several partitions: a group is
    large when it holds more than one part in ``hot_groups`` of all rows, so there are fewer than
    ``hot_groups`` of them. Their list holds two numbers per group and may be broadcast however large
    the tables are and however long the keys.
    """
    stats = stats.dropna(subset=keys)
    if held is None:
        shared_dir(rows.sparkSession)
        stats = stats.checkpoint()
    else:
        held.append(stats := stats.persist())
    key_bytes = sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(64))
    total = stats.agg(
        F.coalesce(F.sum(key_bytes), F.lit(0)).alias("bytes"), F.coalesce(F.sum(size), F.lit(0)).alias("rows")
    ).first()
    if total["bytes"] <= broadcast_bytes:
        return rows.join(F.broadcast(stats), keys)

    share = max(total["rows"] // hot_groups, 1)
    group_hash = F.xxhash64(*keys)
    # Groups that share a hash share the number of parts, on both sides, so a collision does no harm.
    hot = F.broadcast(
        stats.where(F.col(size) > share)
        .groupBy(group_hash.alias("group_hash"))
        .agg(F.max(F.ceil(F.col(size) / share)).alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    # The partition number keeps copies of one row apart and, unlike a random salt, is the same when a
    # lost task runs again.
    salt = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), parts)
    salted = (
        rows.dropna(subset=keys)
        .withColumn("group_hash", group_hash)
        .join(hot, "group_hash", "left")
        .withColumn("salt", salt)
        .drop("group_hash", "parts")
    )
    spread = (
        stats.withColumn("group_hash", group_hash)
        .join(hot, "group_hash", "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .drop("group_hash", "parts")
    )
    return salted.join(spread, [*keys, "salt"]).drop("salt")
