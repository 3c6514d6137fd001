from pyspark.sql import functions as F

from tradeloom.functions import columns as fn


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit(x):
    return F.lit(x).cast("double")


def test_deviation_is_a_fraction_and_null_for_zero_average(spark):
    assert value(spark, fn.deviation(lit(99), lit(100))) == 0.01
    assert value(spark, fn.deviation(lit(99), lit(0))) is None


def test_direction_counts_equal_as_above_and_hint_as_below(spark):
    assert value(spark, fn.direction(lit(5), lit(5))) == "above"
    assert value(spark, fn.direction(lit(4), lit(5))) == "below"
    assert value(spark, fn.alert_direction_hint(lit(5), lit(5))) == "below"
    assert value(spark, fn.alert_direction_hint(lit(6), lit(5))) == "above"


def test_verdict_limits(spark):
    got = [value(spark, fn.reconcile_verdict(lit(x))) for x in (0.99, 1, 5, 5.01)]
    assert got == ["ok", "watch", "watch", "investigate"]


def test_percent_columns(spark):
    assert value(spark, fn.vwap_diff_pct(lit(100), lit(101))) == 1.0
    assert value(spark, fn.vwap_diff_pct(lit(0), lit(1))) is None
    assert value(spark, fn.divergence_pct(lit(101), lit(100))) == 1.0
    assert value(spark, fn.buy_pct(lit(0.6666))) == 66.7


def test_subject_drops_tickers_when_long(spark):
    n, k = F.lit(12), F.lit(3)
    full = value(spark, fn.alert_subject(n, k))
    assert full == "Off-average prices: 3 tickers, 12 trades"
    assert value(spark, fn.alert_subject(n, k, limit=len(full))) == full
    assert value(spark, fn.alert_subject(n, k, limit=len(full) - 1)) == "Off-average prices: 12 trades"
