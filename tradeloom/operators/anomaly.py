"""Trades far from the average price of their peers, and summaries of those found."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import deviation, direction
from tradeloom.operators.projections import clock, gold_project
from tradeloom.operators.skew import join_group_stats

ALERT_COLUMNS = [
    "trade_id", "ticker", "price", "quantity", "side", "event_time", "source",
    "window_avg_price", "deviation_pct", "direction",
]


def ticker_batch_avg(df: DataFrame, group: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """Average price and number of trades per group."""
    return df.groupBy(*group).agg(
        F.avg("price").alias("window_avg_price"), F.count("*").alias("window_trade_count")
    )


def _group_stats(rows: DataFrame, group: list[str]) -> DataFrame:
    """Average, number, and lowest and highest price of each group."""
    return rows.groupBy(*group).agg(
        F.avg("price").alias("window_avg_price"),
        F.count("*").alias("window_trade_count"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
    )


def _with_flagged(stats: DataFrame, threshold: float) -> DataFrame:
    """The groups that hold a flagged trade: just those whose lowest or highest price is one."""
    avg = F.col("window_avg_price")
    return stats.where((deviation(F.col("low"), avg) > threshold) | (deviation(F.col("high"), avg) > threshold)).drop("low", "high")


def _alerts(joined: DataFrame, group: list[str], threshold: float, as_of: datetime | None) -> DataFrame:
    """The flagged ones of trades that stand next to their group's average."""
    price, avg = F.col("price"), F.col("window_avg_price")
    return (
        joined.withColumn("deviation_pct", deviation(price, avg))
        .where(F.col("deviation_pct") > threshold)
        .withColumn("direction", direction(price, avg))
        .select(*[g for g in group if g != "ticker"], *ALERT_COLUMNS, clock(as_of).alias("detected_at"))
    )


def _flag(
    rows: DataFrame, group: list[str], threshold: float, as_of: datetime | None, held: list[DataFrame] | None = None
) -> DataFrame:
    """Trades further than ``threshold`` from the average of their group, itself included.

    Averages come from a partial aggregation and go back to the rows by a join: a window function
    over the group would pull all trades of a busy ticker into one task. A group holds a flagged trade
    just when its lowest or highest price is one, so only those groups enter the join.
    """
    stats = _with_flagged(_group_stats(rows, group), threshold)
    return _alerts(join_group_stats(rows, stats, group, "window_trade_count", held=held), group, threshold, as_of)


def anomaly_self_join(
    df: DataFrame, threshold: float = 0.01, as_of: datetime | None = None, held: list[DataFrame] | None = None
) -> DataFrame:
    """Alerts against the ticker's average over all of ``df``, which is one micro-batch or one table.

    ``held`` gets the averages that are kept for the join, see ``join_group_stats``.
    """
    return _flag(gold_project(df), ["ticker"], threshold, as_of, held)


def flag_batch(df: DataFrame, held: list[DataFrame], threshold: float = 0.01, as_of: datetime | None = None) -> tuple[DataFrame, int]:
    """(alerts, number of trades) of one micro-batch: the averages, which are kept in ``held``, have counted the trades."""
    rows = gold_project(df)
    stats = _group_stats(rows, ["ticker"]).persist()
    held.append(stats)
    trades = stats.agg(F.coalesce(F.sum("window_trade_count"), F.lit(0)).alias("n")).first()["n"]
    joined = join_group_stats(rows, _with_flagged(stats, threshold), ["ticker"], "window_trade_count", held=held)
    return _alerts(joined, ["ticker"], threshold, as_of), trades


def anomaly_by_bucket(
    df: DataFrame, bucket: str = "30 seconds", threshold: float = 0.01, as_of: datetime | None = None
) -> DataFrame:
    """The same against the average of the event-time bucket, so the result does not depend on when
    the batches were cut."""
    rows = gold_project(df).withColumn("bucket", F.window("event_time", bucket)["start"])
    return _flag(rows, ["bucket", "ticker"], threshold, as_of)


def anomaly_by_bucket_stream(
    df: DataFrame, bucket: str = "30 seconds", threshold: float = 0.01, watermark: str = "10 seconds", salts: int = 16,
    as_of: datetime | None = None,
) -> DataFrame:
    """The same alerts from a stream of trades, each bucket once the watermark has reached its end.

    The average of a closed bucket comes out of a windowed aggregation and meets the bucket's trades, which the join keeps
    until then, by (bucket, ticker, salt): trades are stored one by one, and ``salts`` parts of a ticker lie in different
    partitions, so a ticker with most of the trades is no state value and no partition of its own. Averages without a
    flagged trade are left out before they are repeated for the salts. State holds the trades of open buckets only.
    Trades that are late for their bucket are in no average and raise no alert; neither do those without time or ticker.
    """
    rows = gold_project(df).where("event_time IS NOT NULL AND ticker IS NOT NULL").withWatermark("event_time", watermark)
    rows = rows.withColumn("window", F.window("event_time", bucket))
    stats = _with_flagged(_group_stats(rows, ["window", "ticker"]), threshold).select(
        F.window(F.window_time("window"), bucket).alias("window"), "ticker", "window_avg_price",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    # The join allows one column of event time on each side: the window. The trade's own time goes along as a plain one.
    salt = F.pmod(F.xxhash64("trade_id", "price", "quantity", "event_time"), F.lit(salts)).cast("int")
    salted = rows.withColumns({"salt": salt, "at": F.timestamp_micros(F.unix_micros("event_time"))}).drop("event_time")
    joined = salted.join(stats, ["window", "ticker", "salt"]).withColumns({"bucket": F.col("window.start"), "event_time": F.col("at")})
    return _alerts(joined, ["bucket", "ticker"], threshold, as_of)


def batch_rates(commits: DataFrame) -> DataFrame:
    """Flagged and all trades of every micro-batch, from what the gold sink has committed: (batch_id, trades, flagged, rate)."""
    return commits.select("batch_id", "trades", "flagged", F.try_divide("flagged", "trades").alias("rate"))


def anomaly_summary(gold: DataFrame) -> DataFrame:
    """Alerts per ticker: number, size and side."""
    pct = F.col("deviation_pct")
    return (
        gold.groupBy("ticker")
        .agg(
            F.count("*").alias("anomaly_count"),
            F.round(F.avg(pct) * 100, 2).alias("avg_deviation_pct"),
            F.round(F.max(pct) * 100, 2).alias("max_deviation_pct"),
            F.round(F.min(pct) * 100, 2).alias("min_deviation_pct"),
            F.count_if(F.col("direction") == "above").alias("above_count"),
            F.count_if(F.col("direction") == "below").alias("below_count"),
        )
        .orderBy(F.desc("anomaly_count"), F.asc_nulls_last("ticker"))
    )


def anomaly_timeline(gold: DataFrame, ts: str = "detected_at") -> DataFrame:
    """Alerts per minute of ``ts``. Detection time puts one micro-batch into one minute; event time does not."""
    return (
        gold.groupBy(F.date_trunc("minute", ts).alias("minute"))
        .agg(
            F.count("*").alias("anomalies_in_minute"),
            F.count_distinct("ticker").alias("tickers_affected"),
            F.round(F.avg("deviation_pct") * 100, 2).alias("avg_deviation_pct"),
        )
        .orderBy(F.asc_nulls_last("minute"))
    )


def anomaly_rate(df: DataFrame, gold: DataFrame, bucket: str = "30 seconds") -> DataFrame:
    """Flagged and all trades per event-time bucket. Both sides are counted before they meet."""
    slot = F.window("event_time", bucket)["start"].alias("bucket")
    trades = df.groupBy(slot).agg(F.count("*").alias("trades"))
    flagged = gold.groupBy(slot).agg(F.count("*").alias("flagged"))
    joined = trades.join(flagged, "bucket", "left").withColumn("flagged", F.coalesce("flagged", F.lit(0)))
    return joined.withColumn("rate", F.try_divide("flagged", "trades"))
