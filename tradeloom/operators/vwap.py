"""Volume-weighted average price: windows, recomputation, dashboard and comparisons."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import buy_pct, divergence_pct, vwap_diff_pct
from tradeloom.operators.projections import silver_project


PARTIAL_KEYS = ("window", "ticker", "source")


def _window_rows(trades: DataFrame, duration: str, watermark: str | None) -> DataFrame:
    """A row for each trade, in the form of a partial result of its window."""
    rows = silver_project(trades)
    if watermark:
        rows = rows.withWatermark("event_time", watermark)
    return rows.select(
        F.window("event_time", duration).alias("window"),
        "ticker",
        "source",
        F.col("price").alias("low"),
        F.col("price").alias("high"),
        "notional",
        F.col("quantity").cast("long").alias("volume"),
        F.lit(1).cast("long").alias("trades"),
        F.when(F.col("side") == "buy", 1).otherwise(0).cast("long").alias("buys"),
    )


def _reduced(rows: DataFrame) -> DataFrame:
    """Partial results of the same window, ticker and source brought into one."""
    return rows.groupBy(*PARTIAL_KEYS).agg(
        F.sum("notional").alias("notional"),
        F.sum("volume").alias("volume"),
        F.sum("trades").alias("trades"),
        F.sum("buys").alias("buys"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def _finished(rows: DataFrame) -> DataFrame:
    """The VWAP row of each window from its partial results."""
    return rows.groupBy("window", "ticker").agg(
        F.try_divide(F.sum("notional"), F.sum("volume")).alias("vwap"),
        F.sum("volume").alias("total_volume"),
        F.sum("trades").alias("trade_count"),
        F.min("low").alias("low_price"),
        F.max("high").alias("high_price"),
        F.try_divide(F.sum("buys"), F.sum("trades")).alias("buy_ratio"),
        F.min("source").alias("source"),
    )


def vwap(trades: DataFrame, duration: str, watermark: str | None = None) -> DataFrame:
    """One row per (clock-aligned window, ticker).

    Every aggregate merges from partial results, so a ticker with most of the trades costs one small
    row per task in the shuffle. ``source`` is the least one of the window: unlike the first one seen
    it does not depend on row order. Rows without an event time belong to no window.
    """
    rows = _window_rows(trades, duration, watermark)
    if not rows.isStreaming or _chained(rows):
        # The least of a text column cannot be kept in a hash aggregate, and sorting all trades for it
        # costs several times the rest. So the trades are first reduced with the source as a key.
        rows = _reduced(rows)
    if rows.isStreaming and _chained(rows):
        # The same window again, in the form in which a second stateful step knows its event time.
        rows = rows.withColumn("window", F.window(F.window_time("window"), duration))
    return _finished(rows)


def vwap_partials(trades: DataFrame, duration: str = "1 minute", watermark: str | None = None) -> DataFrame:
    """Partial results of short windows, (window_start, window_end, ticker, source, low, high, notional, volume, trades, buys),
    from which the rows of every longer window are merged. From a stream, each once the watermark has reached its end."""
    parts = _reduced(_window_rows(trades, duration, watermark))
    return parts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                        *[c for c in parts.columns if c != "window"])


def merge_partials(partials: DataFrame, duration: str | None = None) -> DataFrame:
    """``vwap`` of windows of ``duration``, a multiple of the partials' windows, without another look at the trades; of
    the partials' own windows if there is none. Several partial results of one window add up."""
    own = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    window = own if duration is None else F.window("window_start", duration)
    return _finished(partials.withColumn("window", window).drop("window_start", "window_end"))


def closed_by_partials(silver: DataFrame, partials: DataFrame) -> DataFrame:
    """The windows that a streamed table of partials holds in full: the newest of its own windows has reached their end."""
    reached = partials.agg(F.max("window_end")).scalar()
    return silver.where(F.col("window_end") <= reached)


def _chained(rows: DataFrame) -> bool:
    """Whether the session lets one stateful step of a stream follow another."""
    return rows.sparkSession.conf.get("spark.sql.streaming.statefulOperator.allowMultiple", "true") == "true"


def closed_windows(silver: DataFrame, trades: DataFrame, watermark: str = "10 seconds") -> DataFrame:
    """The windows an append-mode stream over these trades has written: those whose end the
    watermark (latest event time less the delay) has reached."""
    reached = trades.agg(F.max("event_time") - F.expr(f"INTERVAL {watermark}")).scalar()
    return silver.where(F.col("window_end") <= reached)


def on_day(day: date) -> Column:
    """Partition filter for one day; plain equality on the partition columns, so it prunes."""
    return (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)


def batch_vwap_recompute(bronze: DataFrame, day: date | None = None) -> DataFrame:
    """VWAP per (ticker, minute) of one stored day, or of all, from the stored trades. Trades without a time have no minute."""
    return (
        bronze.where(F.col("event_time").isNotNull() if day is None else on_day(day))
        .groupBy("ticker", F.date_trunc("minute", "event_time").alias("minute"))
        .agg(
            F.try_divide(F.sum(F.col("price") * F.col("quantity")), F.sum(F.col("quantity").cast("double"))).alias(
                "batch_vwap"
            ),
            F.sum("quantity").alias("batch_volume"),
            F.count("*").alias("batch_trades"),
        )
    )


def _streamed(silver: DataFrame, day: date | None) -> DataFrame:
    """The windows that begin on one day, or all."""
    if day is not None:
        first, end = (F.lit(str(d)).cast("timestamp") for d in (day, day + timedelta(days=1)))
        silver = silver.where((F.col("window_start") >= first) & (F.col("window_start") < end))
    return silver.select(
        "ticker",
        F.col("window_start").alias("minute"),
        F.col("vwap").alias("stream_vwap"),
        F.col("total_volume").alias("stream_volume"),
        F.col("trade_count").alias("stream_trades"),
    )


def _side_by_side(bronze: DataFrame, silver: DataFrame, day: date | None, how: str) -> DataFrame:
    """Recomputed and streamed windows; windows without a ticker match each other."""
    batch = batch_vwap_recompute(bronze, day)
    stream = _streamed(silver, day).withColumnsRenamed({"ticker": "stream_ticker", "minute": "stream_minute"})
    same = F.col("ticker").eqNullSafe(F.col("stream_ticker")) & (F.col("minute") == F.col("stream_minute"))
    return batch.join(stream, same, how)


def _compared(joined: DataFrame) -> DataFrame:
    return joined.select(
        "ticker",
        "minute",
        F.round("batch_vwap", 4).alias("batch_vwap"),
        F.round("stream_vwap", 4).alias("stream_vwap"),
        vwap_diff_pct(F.col("batch_vwap"), F.col("stream_vwap")).alias("diff_pct"),
        "batch_volume",
        "stream_volume",
        "batch_trades",
        "stream_trades",
    )


def reconcile_windows(bronze: DataFrame, silver: DataFrame, day: date) -> DataFrame:
    """Streamed against recomputed VWAP for every window of a day that both sides have."""
    return _compared(_side_by_side(bronze, silver, day, "inner"))


def reconcile_all_windows(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """The same for all stored days at once: each side is read once, whatever the number of days."""
    return _compared(_side_by_side(bronze, silver, None, "inner"))


def vwap_reconcile(bronze: DataFrame, silver: DataFrame, day: date | None = None, n: int = 50) -> DataFrame:
    """The ``n`` windows where streamed and recomputed VWAP differ most, of one day or of all."""
    rows = reconcile_all_windows(bronze, silver) if day is None else reconcile_windows(bronze, silver, day)
    return rows.orderBy(F.desc("diff_pct"), F.asc_nulls_last("ticker"), "minute").limit(n)


def vwap_reconcile_coverage(bronze: DataFrame, silver: DataFrame, day: date) -> DataFrame:
    """How many windows both sides have and how many only one has, which the inner join hides."""
    batch, stream = F.col("batch_trades").isNotNull(), F.col("stream_trades").isNotNull()
    return _side_by_side(bronze, silver, day, "full_outer").agg(
        F.count_if(batch & stream).alias("matched"),
        F.count_if(batch & ~stream).alias("batch_only"),
        F.count_if(stream & ~batch).alias("stream_only"),
    )


def vwap_reconcile_coverage_by_day(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """``vwap_reconcile_coverage`` of every day that either side has, one pass over both for all of them."""
    minutes = bronze.where(F.col("event_time").isNotNull()).groupBy("ticker", F.date_trunc("minute", "event_time").alias("minute")).agg(
        F.count("*").alias("batch_trades"))
    stream = silver.select(F.col("ticker").alias("stream_ticker"), F.col("window_start").alias("stream_minute"),
                           F.col("trade_count").alias("stream_trades"))
    same = F.col("ticker").eqNullSafe(F.col("stream_ticker")) & (F.col("minute") == F.col("stream_minute"))
    has_batch, has_stream = F.col("batch_trades").isNotNull(), F.col("stream_trades").isNotNull()
    return (
        minutes.join(stream, same, "full_outer")
        .groupBy(F.to_date(F.coalesce("minute", "stream_minute")).cast("string").alias("day"))
        .agg(
            F.count_if(has_batch & has_stream).alias("matched"),
            F.count_if(has_batch & ~has_stream).alias("batch_only"),
            F.count_if(has_stream & ~has_batch).alias("stream_only"),
        )
    )


def window_divergence(silver_1min: DataFrame, silver_5min: DataFrame) -> DataFrame:
    """Every 1-minute window against the 5-minute window it lies in.

    Windows are aligned to the clock, so lying in a 5-minute window is equality of the 5-minute
    bucket. An equi-join on (ticker, bucket) replaces the range join, whose work per ticker grows
    with the square of the number of windows.
    """
    short = silver_1min.select(
        "ticker",
        F.window("window_start", "5 minutes")["start"].alias("bucket"),
        F.col("window_start").alias("minute"),
        F.col("vwap").alias("v1"),
    )
    long = silver_5min.select("ticker", F.col("window_start").alias("bucket"), F.col("vwap").alias("v5"))
    return short.join(long, ["ticker", "bucket"]).select(
        "ticker",
        "minute",
        F.round("v1", 2).alias("vwap_1min"),
        F.round("v5", 2).alias("vwap_5min"),
        divergence_pct(F.col("v1"), F.col("v5")).alias("divergence_pct"),
    )


def vwap_1m_vs_5m(silver_1min: DataFrame, silver_5min: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` 1-minute windows furthest from their 5-minute window."""
    rows = window_divergence(silver_1min, silver_5min)
    return rows.orderBy(F.desc("divergence_pct"), F.asc_nulls_last("ticker"), "minute").limit(n)


def _dashboard_columns(silver: DataFrame) -> DataFrame:
    return silver.select(
        "ticker",
        "window_start",
        "window_end",
        F.round("vwap", 2).alias("vwap"),
        "total_volume",
        "trade_count",
        buy_pct(F.col("buy_ratio")).alias("buy_pct"),
        "source",
    )


def vwap_dashboard(silver: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` newest rows."""
    return _dashboard_columns(silver).orderBy(F.desc("window_start"), F.asc_nulls_last("ticker")).limit(n)


def vwap_latest(silver: DataFrame) -> DataFrame:
    """The newest window of every ticker: its start by a hash aggregate, then the row by an equi-join."""
    newest = silver.groupBy(F.col("ticker").alias("of")).agg(F.max("window_start").alias("newest"))
    held = silver.join(newest, F.col("ticker").eqNullSafe(F.col("of")) & (F.col("window_start") == F.col("newest")))
    return _dashboard_columns(held)
