"""Column expressions shared by batch and streaming plans. Division by zero gives NULL throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def notional(price: Column, quantity: Column) -> Column:
    """Money value of a trade."""
    return price * quantity


def deviation(price: Column, avg: Column) -> Column:
    """Distance from the average as a fraction of it: 0.01 is one percent."""
    return F.try_divide(F.abs(price - avg), avg)


def direction(price: Column, avg: Column) -> Column:
    """``above`` from the average upwards, else ``below``."""
    return F.when(price >= avg, "above").otherwise("below")


def vwap_diff_pct(batch: Column, stream: Column) -> Column:
    """Difference of a streamed VWAP from its recomputed value, in percent of the latter."""
    return F.round(F.try_divide(F.abs(batch - stream), batch) * 100, 4)


def divergence_pct(vwap_1min: Column, vwap_5min: Column) -> Column:
    """Difference of a 1-minute VWAP from its 5-minute VWAP, in percent of the latter."""
    return F.round(F.try_divide(F.abs(vwap_1min - vwap_5min), vwap_5min) * 100, 2)


def buy_pct(ratio: Column) -> Column:
    return F.round(ratio * 100, 1)


def reconcile_verdict(diff_pct: Column) -> Column:
    """Under 1 percent is fine, over 5 percent needs a look, anything between is worth watching."""
    return F.when(diff_pct < 1, "ok").when(diff_pct > 5, "investigate").otherwise("watch")


def alert_direction_hint(avg_price: Column, avg_window_price: Column) -> Column:
    """Side of a ticker's flagged prices as a whole. Unlike ``direction``, equal counts as below."""
    return F.when(avg_price > avg_window_price, "above").otherwise("below")


def alert_subject(trades: Column, tickers: Column, limit: int = 100) -> Column:
    """Subject line with both totals; the short form drops the ticker total above ``limit`` characters."""
    full = F.format_string("Off-average prices: %d tickers, %d trades", tickers, trades)
    short = F.format_string("Off-average prices: %d trades", trades)
    return F.when(F.length(full) > limit, short).otherwise(full)


def _two_decimals(x: Column) -> Column:
    """Half upwards. The inner rounding drops the last digits, which the order of a sum moves."""
    return F.floor(F.round(x * 100, 6) + 0.5) / 100


def percent_text(fraction: Column) -> Column:
    return F.format_string("%.2f%%", _two_decimals(fraction * 100))


def money_text(amount: Column) -> Column:
    return F.format_string("$%.2f", _two_decimals(amount))
