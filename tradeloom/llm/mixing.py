"""Temperature mixing of sources: token shares to a power, realised as block permutations within a budget.

A source with T tokens gets a weight in proportion to T to the power a. At a = 1 the mixture is the corpus, at
a = 0 every source weighs the same. The exponent is found by bisection, then the weights become token budgets:
full passes over a source, and one more pass, over its blocks in random order, until the budget is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tradeloom.llm.frames import fresh_name, keep

STEPS = 40
BLOCK_DIGITS = 3  # hex digits of a row's key that name its block: 4,096 blocks a source
BROADCAST_SOURCES = 10_000  # beyond so many sources their budgets are joined by a shuffle


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def row_key(df: DataFrame, columns: list[str], seed: str) -> Column:
    """A hash of the seed and the named columns, in hex; its order is a random permutation of the rows."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def block_order(seed: str, one_more: Column, block: Column) -> Column:
    """The blocks' order in the last, partial pass."""
    return F.md5(F.concat_ws(":", F.lit(seed), one_more.cast("string"), block))


def _mixture(sources: DataFrame, exponent: float) -> DataFrame:
    """One row: sum of the powered sizes, entropy in bits, largest and smallest size."""
    power = F.pow(F.col("tokens").cast("double"), F.lit(exponent))
    return sources.agg(
        F.sum(power).alias("z"), F.sum(power * F.log2(power)).alias("p"),
        F.max("tokens").alias("largest"), F.min("tokens").alias("smallest"))


def exponent_for(sources: DataFrame, budget: int | None, target_entropy: float | None, max_repeats: float | None) -> float:
    """The exponent in [0, 1], by bisection over ``sources`` (source, tokens > 0).

    The smallest one, and so the flattest mixture, whose entropy is at most ``target_entropy`` (in bits) and that
    passes over no source more than ``max_repeats`` times. If none does, it is 1.
    """
    def holds(exponent: float) -> bool:
        m = _mixture(sources, exponent).first()
        if m["z"] is None:
            return True
        total = budget or m["largest"] * m["z"] / m["largest"] ** exponent
        repeats = m["smallest"] ** (exponent - 1.0) * total / m["z"]
        entropy = math.log2(m["z"]) - m["p"] / m["z"]
        return (max_repeats is None or repeats <= max_repeats) and (target_entropy is None or entropy <= target_entropy)

    if holds(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def budgets(
    digest: DataFrame, seed: str, budget: int | None = None, target_entropy: float | None = None,
    max_repeats: float | None = None,
) -> DataFrame:
    """Per source what ``realise`` needs, from rows (source, tokens, key).

    weight and epochs (the budget in passes over the source, rounded to nine decimals), full_passes, and the end
    of the partial pass: the order of the block it ends in and the last key taken there. Without ``budget`` the
    budget is the smallest that passes over every source at least once, so that no row is lost. A source
    without tokens has weight 0 and is passed over once.
    """
    block = F.substring("key", 1, BLOCK_DIGITS)
    blocks = keep(digest.groupBy("source", block.alias("block")).agg(F.sum("tokens").alias("tokens")))
    totals = keep(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")))
    filled = totals.where("tokens > 0")
    exponent = exponent_for(filled, budget, target_entropy, max_repeats)
    m = _mixture(filled, exponent).first()
    z = m["z"] or 1.0
    total = budget or (m["largest"] or 1) * z / (m["largest"] or 1) ** exponent
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(exponent)) / F.lit(z)).otherwise(F.lit(0.0))
    epochs = F.when(F.col("tokens") > 0, F.round(F.col("weight") * F.lit(float(total)) / F.col("tokens"), 9)).otherwise(F.lit(1.0))
    sources = (
        totals.withColumn("weight", weight).withColumn("epochs", epochs)
        .withColumn("full_passes", F.floor("epochs"))
        .withColumn("more", F.round((F.col("epochs") - F.col("full_passes")) * F.col("tokens")).cast("long"))
        .withColumnRenamed("tokens", "source_tokens")
    )

    along = Window.partitionBy("source").orderBy("ordered").rowsBetween(Window.unboundedPreceding, -1)
    laid = (
        blocks.join(sources.where("more > 0").select(F.col("source").alias("of"), "full_passes", "more"),
                    F.col("source").eqNullSafe(F.col("of")))
        .withColumn("ordered", block_order(seed, F.col("full_passes") + 1, F.col("block")))
        .withColumn("before", F.coalesce(F.sum("tokens").over(along), F.lit(0)))
    )
    last = laid.where("before < more AND before + tokens >= more").select(
        "of", "ordered", F.col("block").alias("last_block"), (F.col("more") - F.col("before")).alias("left"))
    in_block = Window.partitionBy("of").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        digest.join(last, F.col("source").eqNullSafe(F.col("of")) & (block == F.col("last_block")))
        .withColumn("upto", F.sum("tokens").over(in_block))
        .where("upto >= left").groupBy("of", "ordered").agg(F.min("key").alias("last_key"))
        .withColumnRenamed("of", "ended")
    )
    return sources.join(ends, F.col("source").eqNullSafe(F.col("ended")), "left").drop("ended", "more")


def realise(df: DataFrame, source: str, key: str, seed: str, plan: DataFrame, into: str = "pass") -> DataFrame:
    """The rows of ``df`` as often as ``plan`` (from ``budgets``) says, numbered from 1 in ``into``.

    ``df`` has the plan's weight and epochs too. No row moves for it unless the plan has more than
    BROADCAST_SOURCES sources. Rows alike in source and key share their fate.
    """
    plan = keep(plan)
    p = fresh_name(df, "_plan")
    packed = plan.select(F.struct("*").alias(p))
    if plan.count() <= BROADCAST_SOURCES:
        packed = F.broadcast(packed)
    df = df.join(packed, F.col(source).eqNullSafe(F.col(f"{p}.source")))
    order = block_order(seed, F.col(f"{p}.full_passes") + 1, F.substring(key, 1, BLOCK_DIGITS))
    end, last = F.col(f"{p}.ordered"), F.col(f"{p}.last_key")
    extra = F.coalesce((order < end) | ((order == end) & (F.col(key) <= last)), F.lit(False))
    passes = (F.col(f"{p}.full_passes") + extra.cast("long")).cast("int")
    repeated = df.where(passes > 0).withColumn(into, F.explode(F.sequence(F.lit(1), passes)))
    return repeated.withColumns({"weight": F.col(f"{p}.weight"), "epochs": F.col(f"{p}.epochs")}).drop(p)


def mix_digest(rows: DataFrame, seed: str = "mix", budget: int | None = None, target_entropy: float | None = None,
               max_repeats: float | None = None) -> DataFrame:
    """The mixture of narrow rows with the columns source, tokens and key (see ``row_key``).

    They are written once and come back, with all their columns, as often as their source's budget says, with
    ``pass``, weight and epochs. Null sources are one source, null tokens count as none. An empty frame gives
    an empty mixture. Training order within a pass is that of the blocks and, inside, of the keys.
    """
    rows = keep(rows.withColumn("tokens", F.coalesce(F.col("tokens"), F.lit(0)).cast("long")))
    plan = budgets(rows.select("source", "tokens", "key"), seed, budget, target_entropy, max_repeats)
    return realise(rows, "source", "key", seed, plan)


def mix(
    df: DataFrame, source: str, tokens: Column, identity: list[str], seed: str = "mix", budget: int | None = None,
    target_entropy: float | None = None, max_repeats: float | None = None,
) -> DataFrame:
    """The mixture of ``df`` with its own columns, whatever their names, a row for each time that it is used.

    ``identity`` names the columns that a row's place in the permutations depends on. Nulls and empty frames are
    treated as in ``mix_digest``. Wide rows are not written: the budgets come from a narrow pass, and a second one
    repeats the rows where they are.
    """
    key = row_key(df, identity, seed)
    digest = keep(df.select(F.col(source).alias("source"), F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"), key.alias("key")))
    plan = budgets(digest, seed, budget, target_entropy, max_repeats)
    k, n, wide = fresh_name(df, "_key"), fresh_name(df, "_pass"), fresh_name(df, "_row")
    narrow = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(wide), F.col(source).alias("source"), key.alias(k))
    return realise(narrow, "source", k, seed, plan, n).select(*[F.col(f"{wide}.`{c}`") for c in df.columns])
