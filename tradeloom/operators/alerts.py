"""Digest of stored alerts, a head per alert file and a block per ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import alert_direction_hint, alert_subject, money_text, percent_text


def _per_ticker(gold: DataFrame, file_col: str) -> DataFrame:
    return gold.groupBy(file_col, "ticker").agg(
        F.count("*").alias("rows"),
        F.count("trade_id").alias("alerts"),
        F.avg("deviation_pct").alias("avg_deviation"),
        F.max("deviation_pct").alias("max_deviation"),
        F.avg("price").alias("avg_price"),
        F.avg("window_avg_price").alias("avg_window_price"),
    )


def alert_summary(gold: DataFrame, file_col: str) -> DataFrame:
    """Alerts per file and ticker. Rows without a ticker are in no group."""
    return _per_ticker(gold.dropna(subset=["ticker"]), file_col).drop("rows")


def alert_digest(gold: DataFrame, file_col: str, threshold: float = 0.01) -> DataFrame:
    """(file, ticker, subject, body): a head for each file, whose ticker is NULL, and a block for each of its tickers.

    Alerts are reduced to one row per ticker before any text is made, and the rows of a file are never brought
    together, so a file may have any number of tickers. Alerts without a ticker count in the head and have no block.
    The digest reads head first, then the blocks by ticker.
    """
    avg_price, avg_window = F.col("avg_price"), F.col("avg_window_price")
    by_ticker = _per_ticker(gold, file_col)
    totals = by_ticker.groupBy(file_col).agg(F.sum("rows").alias("total"), F.count("ticker").alias("tickers"))
    subject = alert_subject(F.col("total"), F.col("tickers"))
    head = F.format_string(
        f"%s\n%d alerts on %d tickers, off the average by more than {threshold * 100:g}%%\n", file_col, "total", "tickers")
    block = F.concat(
        F.format_string("%s: %d alerts\n", "ticker", "alerts"),
        F.lit("  deviation "), percent_text(F.col("avg_deviation")), F.lit(" on average, "),
        percent_text(F.col("max_deviation")), F.lit(" at most\n"),
        F.lit("  price "), money_text(avg_price), F.lit(", "), alert_direction_hint(avg_price, avg_window),
        F.lit(" the average of "), money_text(avg_window), F.lit("\n"),
    )
    heads = totals.select(F.col(file_col).alias("file"), F.lit(None).cast("string").alias("ticker"), subject.alias("subject"), head.alias("body"))
    blocks = by_ticker.where("ticker IS NOT NULL").select(
        F.col(file_col).alias("file"), "ticker", F.lit(None).cast("string").alias("subject"), block.alias("body"))
    return heads.unionByName(blocks)
