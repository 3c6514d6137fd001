"""Quality checks over the stored trades and over the raw feed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.projections import clock, typed_event_time
from tradeloom.operators.stats import surplus_ids
from tradeloom.schema import GATE_FAILED, GATE_PASSED, REFERENCE_TICKERS, SIDES, WIRE

DUPLICATES = "duplicate_ids"
VALIDATION = (
    "null_trade_id", "null_ticker", "negative_price", "zero_quantity",
    "invalid_side", "null_timestamp", "future_trades",
)
ALL = (*VALIDATION, DUPLICATES)
GATE = tuple(c for c in ALL if c != "future_trades")


class DataQualityError(Exception):
    """Raised by the gate; ``failures`` lists (check, violations)."""

    def __init__(self, failures: list[tuple[str, int]]):
        self.failures = failures
        listed = ", ".join(f"{name}: {n}" for name, n in failures)
        super().__init__(f"{len(failures)} quality checks failed ({listed})")


def row_rules(as_of: datetime | None = None, tickers: Sequence[str] = REFERENCE_TICKERS) -> dict[str, Column]:
    """Check name to the condition a violating row meets. A NULL condition is no violation."""
    c = F.col
    return {
        "null_trade_id": c("trade_id").isNull(),
        "null_ticker": c("ticker").isNull(),
        "negative_price": c("price") <= 0,
        "zero_quantity": c("quantity") <= 0,
        "invalid_side": ~c("side").isin(*SIDES),
        "null_timestamp": c("event_time").isNull(),
        "future_trades": c("event_time") > clock(as_of) + F.expr("INTERVAL 5 MINUTES"),
        "spread": ~((c("bid_price") < c("price")) & (c("price") < c("ask_price"))),
        "ticker_domain": ~F.coalesce(c("ticker").isin(*tickers), F.lit(False)),
    }


def violations(
    df: DataFrame, check: str, as_of: datetime | None = None, tickers: Sequence[str] = REFERENCE_TICKERS
) -> DataFrame:
    """The rows that break one rule."""
    return df.where(row_rules(as_of, tickers)[check])


def dq_checks(
    df: DataFrame,
    checks: Sequence[str] = ALL,
    as_of: datetime | None = None,
    tickers: Sequence[str] = REFERENCE_TICKERS,
) -> DataFrame:
    """Violations per check, as (check_name, violations).

    All row rules are counted in one pass without a shuffle of rows. The duplicate check needs the ids
    brought together, so it reads the id column on its own and does not drag the counts along.
    """
    rules = row_rules(as_of, tickers)
    parts = []
    counted = [c for c in checks if c != DUPLICATES]
    if counted:
        counts = df.agg(*[F.count_if(rules[c]).alias(c) for c in counted])
        parts.append(counts.unpivot([], counted, "check_name", "violations"))
    if DUPLICATES in checks:
        parts.append(df.agg(surplus_ids().alias("violations")).select(F.lit(DUPLICATES).alias("check_name"), "violations"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def dq_gate(df: DataFrame, checks: Sequence[str] = GATE, as_of: datetime | None = None) -> dict:
    """Run the checks; raise if any row violates one."""
    found = [(r["check_name"], r["violations"]) for r in dq_checks(df, checks, as_of).collect()]
    failures = [(name, n) for name, n in found if n > 0]
    if failures:
        raise DataQualityError(failures)
    return {"status": GATE_PASSED, "checks_run": len(found), "violations": 0}


def gate_report(df: DataFrame, checks: Sequence[str] = GATE, as_of: datetime | None = None) -> DataFrame:
    """What the gate would decide, as one row and without raising."""
    return report_of(dq_checks(df, checks, as_of))


def report_of(found: DataFrame) -> DataFrame:
    """What the gate decides from (check_name, violations), whether counted now or taken from profiles."""
    total = F.sum("violations")
    return found.agg(
        F.when(total == 0, GATE_PASSED).otherwise(GATE_FAILED).alias("status"),
        F.count("*").alias("checks_run"),
        F.count_if(F.col("violations") > 0).alias("checks_failed"),
        total.alias("violations"),
    )


def dq_schema_complete(raw: DataFrame, payload_col: str) -> DataFrame:
    """Payloads that lack one of the wire fields. A field sent as null is there; text that is no JSON object lacks all."""
    keys = F.coalesce(F.json_object_keys(F.col(payload_col).cast("string")), F.array().cast("array<string>"))
    missing = F.array_except(F.array(*[F.lit(n) for n in WIRE.names]), keys)
    return raw.agg(F.count_if(F.size(missing) > 0).alias("violations")).select(
        F.lit("schema_complete").alias("check_name"), "violations"
    )


def dq_timestamp_iso(wire: DataFrame) -> DataFrame:
    """Wire rows whose timestamp text does not parse; a missing timestamp is another check's business."""
    bad = F.col("timestamp").isNotNull() & typed_event_time(wire).isNull()
    return wire.agg(F.count_if(bad).alias("violations")).select(F.lit("timestamp_iso").alias("check_name"), "violations")


def dq_ticker_coverage(df: DataFrame, minimum: int, per: str = "1 minute") -> DataFrame:
    """Intervals in which fewer than ``minimum`` tickers traded."""
    return (
        df.groupBy(F.window("event_time", per)["start"].alias("window_start"))
        .agg(F.count_distinct("ticker").alias("tickers"))
        .where(F.col("tickers") < minimum)
    )
