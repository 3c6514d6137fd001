"""Quality of a growing table from profiles of its days, so that a gate reads new days only.

A profile of a day has a row of counts (rows, violations of every row rule, owned ids) and the ids that the day owns, in
hash buckets. Every id is owned by one day: the first that was profiled with it, the earliest of those profiled together.
So ids are stored once, the owned ids of all days are the distinct ids of the table, and the surplus ones are the rows less
those. A day that is profiled again, because late trades have come for it, keeps what it owns and adds what no other day
has. Counts add up over days, whatever the order in which the days came.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.operators.quality import ALL, DUPLICATES, row_rules
from tradeloom.schema import REFERENCE_TICKERS
from tradeloom.sources.commits import file_system

ID_BUCKETS = 64
NO_DAY = "none"  # stands for the day of trades without a time
IDS = T.StructType([T.StructField("trade_id", T.StringType()), T.StructField("bucket", T.IntegerType())])


def rule_names() -> list[str]:
    return [*[c for c in ALL if c != DUPLICATES], "spread", "ticker_domain"]


def counts_schema() -> T.StructType:
    names = ["profile", "day", "rows", "owned_ids", *rule_names()]
    return T.StructType([T.StructField(n, T.StringType() if n in ("profile", "day") else T.LongType()) for n in names])


def day_of() -> Column:
    """The stored day of a row of bronze, by its partition columns."""
    return F.coalesce(F.make_date("year", "month", "day").cast("string"), F.lit(NO_DAY))


def on_days(days: Sequence[date | None]) -> Column:
    """Partition filter for some days; None stands for trades without a time."""
    def one(d: date | None) -> Column:
        if d is None:
            return F.col("year").isNull()
        return (F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day)

    return reduce(lambda a, b: a | b, map(one, days))


def _names(days: Sequence[date | None]) -> list[str]:
    return [NO_DAY if d is None else d.isoformat() for d in days]


def profile_days(
    bronze: DataFrame, days: Sequence[date | None], path: str, as_of: datetime | None = None, tickers: Sequence[str] = REFERENCE_TICKERS,
) -> None:
    """Profile some days of the stored trades into ``path``, in place of what is there of them.

    Reads those days of ``bronze`` only, once for the counts and once for the ids. Their ids meet the stored owned ids by
    a join on (bucket, id). Ids go to a folder of their own, and one row for each day, written last, names it: a profile
    that fails half-way does not count. ``future_trades`` is as of this run. One profile may run at a time.
    """
    spark = bronze.sparkSession
    rows = bronze.where(on_days(days)).withColumn("profiled_day", day_of())
    rules = row_rules(as_of, tickers)
    counts = rows.groupBy("profiled_day").agg(F.count("*").alias("rows"), *[F.count_if(rules[c]).alias(c) for c in rule_names()])
    name = uuid.uuid4().hex
    bucket = F.pmod(F.xxhash64("trade_id"), F.lit(ID_BUCKETS)).cast("int")
    new = rows.where("trade_id IS NOT NULL").groupBy("trade_id").agg(F.min("profiled_day").alias("day")).withColumn("bucket", bucket)
    # A day profiled again keeps the ids it owned, though an earlier day of this run has them too.
    before = owned_ids(spark, path)
    if before is not None:
        others = before.where(~F.col("day").isin(*_names(days))).select("bucket", "trade_id")
        new = new.join(others, ["bucket", "trade_id"], "left_anti")
    ids = f"{path}/ids/profile={name}"
    new.select("trade_id", "day", "bucket").write.partitionBy("day", "bucket").parquet(ids)
    owned = read_ids(spark, ids).groupBy("day").agg(F.count("*").alias("owned_ids"))
    asked = spark.createDataFrame([(d,) for d in _names(days)], "day string")
    done = asked.join(counts.withColumnRenamed("profiled_day", "day"), "day", "left").join(owned, "day", "left")
    zero = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("rows", "owned_ids", *rule_names())]
    # One row for each day of the run.
    done.select(F.lit(name).alias("profile"), "day", *zero).coalesce(1).write.parquet(f"{path}/counts/at={_next(spark, path):012d}")


def _next(spark: SparkSession, path: str) -> int:
    fs, pattern = file_system(spark, f"{path}/counts/at=*")
    return 1 + max((int(s.getPath().getName()[3:]) for s in fs.globStatus(pattern) or []), default=0)


def day_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """The last finished profile of every day: (profile, day, rows, owned_ids, a column for each rule)."""
    fs, pattern = file_system(spark, f"{path}/counts/at=*/_SUCCESS")
    if not fs.globStatus(pattern):
        return None
    found = spark.read.schema(counts_schema().add("at", T.LongType())).parquet(f"{path}/counts")
    columns = [f.name for f in counts_schema().fields if f.name != "day"]
    last = found.groupBy("day").agg(F.max_by(F.struct(*columns), "at").alias("last"))
    return last.select("day", *[F.col("last")[c].alias(c) for c in columns])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T.StructType([*IDS.fields, T.StructField("day", T.StringType())])).parquet(path)


def owned_ids(spark: SparkSession, path: str) -> DataFrame | None:
    """(trade_id, bucket, day) of the ids that the days of the last profiles own."""
    counts = day_counts(spark, path)
    if counts is None:
        return None
    fields = [*IDS.fields, T.StructField("profile", T.StringType()), T.StructField("day", T.StringType())]
    stored = spark.read.schema(T.StructType(fields)).parquet(f"{path}/ids")
    return stored.join(F.broadcast(counts.select("profile", "day")), ["profile", "day"], "left_semi").select("trade_id", "bucket", "day")


def profiled_checks(spark: SparkSession, path: str, checks: Sequence[str] = ALL) -> DataFrame:
    """(check_name, violations) of all profiled days: what ``dq_checks`` says of the whole table, from a row for each day."""
    counts = day_counts(spark, path)
    if counts is None:
        counts = spark.createDataFrame([], counts_schema())
    known = {c: F.sum(c) for c in rule_names()} | {DUPLICATES: F.sum(F.col("rows") - F.col("owned_ids"))}
    sums = counts.agg(*[F.coalesce(known[c], F.lit(0)).alias(c) for c in checks])
    return sums.unpivot([], list(checks), "check_name", "violations")
