"""The corpus operators as named queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import editprint, mixing, neighbours, packing, pii, quality, repair, shards, simjoin, superkmers, tokenalign, toxicity, urlfilter
from tradeloom.llm.frames import kept_table, table, text_bytes
from tradeloom.llm.learning import fold
from tradeloom.llm.oracle import ORACLE  # noqa: F401

SHARDS = 24
QUALITY_KEPT = 0.3
TOXIC_FROM = 0.5
MOST_PASSES = 2.0
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document to one of 24 shards by its id, with its place there and its shard if there were 25."""
    content = text_bytes(F.col("text"))
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select(
        F.col("doc_id").cast("long"),
        (F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(8)).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    docs = shards.assign_shards(docs, "doc_id", SHARDS)
    docs = shards.assign_shards(docs, "doc_id", SHARDS + 1, "grown_shard")
    numbered = shards.number_slots(docs, "shard", "doc_id")
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a field over its lines."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    field = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(docs, field).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= QUALITY_KEPT).cast("int").alias("predicted"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return neighbours.nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a factorization machine over its terms."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, machine).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flattest mixture of the sources that uses each at least once and none more than twice."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    words = mixing.word_count(F.col("text"))
    key = mixing.row_key(docs, ["doc_id", "text"], "mix")
    rows = docs.select("doc_id", "source", words.alias("tokens"), key.alias("key"))
    return mixing.mix_digest(rows, "mix", max_repeats=MOST_PASSES).select(
        "doc_id", "source", "tokens", F.round("weight", 9).alias("weight"), "epochs", "pass")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of power-of-two lengths up to 1024."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    packed = packing.pieces(docs, "doc_id", "text", public_tokenizers.path(TOKENIZER), window=1024)
    return packed.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op7_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return urlfilter.judge(pages, "url", rules).select("page_id", "host", "path", "rule", "verdict")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    counts = [pii.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


def op9_simjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document under links of Jaccard similarity 0.85 on four-word shingles."""
    return simjoin.join_groups(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", width=4, percent=85)


def op10_editprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and of its edited text."""
    return editprint.fingerprint_documents(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


def op10_nearprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document under links of near fingerprints."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    prints = kept_table(editprint.fingerprint_documents(docs, "doc_id", "text").select("doc_id", "fingerprint"))
    return editprint.near_groups(prints, "doc_id", "fingerprint")


def op11_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 13-word windows that also start in a document of smaller id."""
    left = superkmers.drop_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by a hash of its rows, with its faults, its cheapest edits and the repaired text's hash."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.repair_conversations(rows, "conv_id", "turn", "role", "text")


def op13_tokenalign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers align in every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return tokenalign.align_corpus(docs, "doc_id", "text", public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_quality": op2_quality,
    "op3_neighbours": op3_neighbours,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_packing": op6_packing,
    "op7_urlfilter": op7_urlfilter,
    "op8_pii": op8_pii,
    "op9_simjoin": op9_simjoin,
    "op10_editprint": op10_editprint,
    "op11_superkmers": op11_superkmers,
    "op12_repair": op12_repair,
    "op13_tokenalign": op13_tokenalign,
}

#: Further queries of an operator.
MORE_QUERIES = {"op10_nearprints": op10_nearprints}
