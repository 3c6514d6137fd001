"""Helpers on DataFrames shared by the corpus operators."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.config import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there, whatever executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def kept_table(df: DataFrame) -> DataFrame:
    """As ``keep`` for wider or longer intermediate tables: as Parquet, which is compressed, in the shared folder."""
    path = f"{shared_dir(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df``, to be broadcast in a join if it has at most ``rows`` rows, of bounded width."""
    return F.broadcast(df) if df.count() <= rows else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until ``df`` has no column of that name (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let texts go to Python in batches of so many rows, unless the session says how many: Spark's own 10,000 rows of
    long texts would take more memory than the work on them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Return memory that this process has freed to the system. An executor keeps its Python workers, often more than it
    has cores, for later tasks, and what each holds counts as the executor's."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library is glibc
        if trim:
            trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on the batches of a task, with ``give_back`` at its end."""
    def read(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return read


def ascii_lower(column: Column) -> Column:
    """Lower-case A to Z and leave every other letter alone."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(column: Column) -> Column:
    return F.encode(F.coalesce(column, F.lit("")), "UTF-8")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
