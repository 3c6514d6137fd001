"""Folds and bounded training samples for the classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.frames import bounded_batches, giving_back

FOLDS = 5


def fold(key: Column) -> Column:
    """0 to 4 by the key's CRC-32 as text; fold 0 is held out of training. A null key is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(FOLDS)), F.lit(0)).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, target: str, rows: int) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents, of each label at most half, in random but fixed order.

    Only folds 1 to 4 are taken. A key with several labels has the highest. The chosen labels are bounded by
    ``rows`` and so are broadcast; the documents are read once and do not move.
    """
    bounded_batches(docs.sparkSession)
    known = (
        labels.where(F.col(key).isNotNull() & F.col(target).isin(0, 1) & (fold(F.col(key)) != 0))
        .groupBy(key).agg(F.max(target).cast("int").alias("label"))
    )
    place = F.xxhash64(F.col(key).cast("string"), F.lit(target))
    halves = [known.where(F.col("label") == v).orderBy(place, key).limit(rows // 2) for v in (0, 1)]
    chosen = F.broadcast(halves[0].union(halves[1]).select(F.col(key).alias("_chosen"), "label"))
    return docs.select(key, F.col(text).alias("text")).join(chosen, F.col(key) == F.col("_chosen")).select("text", "label")


def label_odds(labels: DataFrame, key: str, target: str) -> float:
    """Log odds of label 1 among all labelled rows of folds 1 to 4, smoothed by one row of each."""
    counts = labels.where(F.col(target).isin(0, 1) & (fold(F.col(key)) != 0)).agg(
        F.count_if(F.col(target) == 1).alias("ones"), F.count_if(F.col(target) == 0).alias("zeros")).first()
    return float(np.log((counts["ones"] + 1) / (counts["zeros"] + 1)))


def score_column(text: Column, model, spark: SparkSession) -> Column:
    """``model.score`` of a column of texts, a double; the model travels once to each executor."""
    bounded_batches(spark)
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return giving_back(lambda texts: (pa.array(held.value.score(t), pa.float64()) for t in texts))(batches)

    return score(text)
