"""Steps between consecutive prices of a ticker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "ticker string, part int, first_price double, last_price double, largest double"


def price_jump(df: DataFrame, limit_pct: float = 2.0) -> DataFrame:
    """Largest step per ticker in percent of the earlier price, flagged from ``limit_pct`` upwards.

    ``lag`` over the ticker would sort all its trades in one task. The trades are range-partitioned
    by (ticker, time, id, price) instead, so a busy ticker spreads over many partitions; each partition
    reduces a ticker's run to its first price, last price and largest inner step. Those chunks, at most
    one per ticker and partition, follow each other in partition order, and the steps across their
    borders are added.
    """
    order = ["ticker", "event_time", "trade_id", "price"]
    rows = df.select(*order).dropna(subset=["ticker", "event_time", "price"])
    # Equal rows may stand in any order, so the partition they were read in can split a heap of them.
    rows = rows.withColumn("read_in", F.spark_partition_id())
    ranged = rows.repartitionByRange(*order, "read_in").sortWithinPartitions(*order)
    chunks = ranged.select("ticker", "price").mapInArrow(_chunk_reducer(), CHUNK)

    before = F.lag("last_price").over(Window.partitionBy("ticker").orderBy("part"))
    border = F.try_divide(F.abs(F.col("first_price") - before), before) * 100
    return (
        chunks.withColumn("largest", F.greatest("largest", border))
        .groupBy("ticker")
        .agg(F.max("largest").alias("max_jump_pct"))
        .withColumn("flagged", F.coalesce(F.col("max_jump_pct") >= limit_pct, F.lit(False)))
    )


def _chunk_reducer():
    """The per-partition pass. Nested, so that it travels to the executors by value."""

    def reduce_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def emit(runs: list[list]) -> pa.RecordBatch:
            ticker, first, last, largest = zip(*runs)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ticker, pa.string()),
                    pa.array([part] * len(runs), pa.int32()),
                    pa.array(first, pa.float64()),
                    pa.array(last, pa.float64()),
                    # NaN marks a run without a step
                    pa.array(np.array(largest, dtype="float64"), pa.float64(), from_pandas=True),
                ],
                names=["ticker", "part", "first_price", "last_price", "largest"],
            )

        run = None  # [ticker, first price, last price, largest step] of the ticker being read
        for batch in batches:
            if not batch.num_rows:
                continue
            ticker = batch.column(0).dictionary_encode()
            code = ticker.indices.to_numpy()
            price = batch.column(1).to_numpy()
            starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            names = ticker.dictionary.take(pa.array(code[starts])).to_pylist()

            goes_on = run is not None and run[0] == names[0]
            previous = np.r_[run[2] if goes_on else np.nan, price[:-1]]
            previous[starts[1:]] = np.nan
            previous[previous == 0] = np.nan
            largest = np.fmax.reduceat(np.abs(price - previous) / previous * 100, starts)
            ends = np.r_[starts[1:], len(price)] - 1

            runs = [list(r) for r in zip(names, price[starts], price[ends], largest)]
            if goes_on:
                runs[0][1] = run[1]
                runs[0][3] = np.fmax(runs[0][3], run[3])
            elif run is not None:
                runs.insert(0, run)
            run = runs.pop()
            if runs:
                yield emit(runs)
        if run is not None:
            yield emit([run])

    return reduce_partition
