"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage takes what the one before has kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.config import shared_dir
from tradeloom.llm import mixing, packing, pii, quality, simjoin
from tradeloom.llm.frames import kept_table, table
from tradeloom.llm.queries import MOST_PASSES, QUALITY_KEPT, TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality field rejects."""
    field = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(docs, field).where(F.col("score") >= QUALITY_KEPT).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each group of near copies: five-word shingles, 0.8 or more.

    Rows have numbers of their own in the join, so rows that share an id but not the text, and rows without an id, are
    documents like others; an id comes before none. Rows alike in id and text are one document.
    """
    rows = kept_table(docs.select(F.monotonically_increasing_id().alias("row"), *COLUMNS))
    groups = simjoin.join_groups(rows.select("row", "text"), "row", "text", width=5, percent=80)
    places = rows.select("row", "doc_id", F.sha2("text", 256).alias("content"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content", "row")
    first = groups.join(places, "row").groupBy("component_id").agg(F.min(place).alias("first")).select("first.*")
    stay = first.groupBy("doc_id", "content", F.when(F.col("none"), F.col("row")).alias("own")).agg(F.min("row").alias("row"))
    return rows.join(stay.select("row"), "row", "left_semi").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind."""
    masked = pii.mask(docs.select(*COLUMNS), "doc_id", "text")
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at least once, small ones up to twice: a row for each time that a document is used."""
    return mixing.mix(docs.select(*COLUMNS), "source", mixing.word_count(F.col("text")), ["doc_id", "text"],
                      max_repeats=MOST_PASSES).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of power-of-two lengths."""
    return packing.pieces(docs, "doc_id", "text", public_tokenizers.path(TOKENIZER), window=1024)


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL has no tokenizer and no trained classifier; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``; what a stage keeps is written to the shared folder."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
