"""Approximate nearest neighbours by cross-polytope hashing.

Fast pseudo-rotations (random signs and a Hadamard transform, three times over) turn the direction of each vector, and
its bucket in a table is the signed axis nearest to it. A query probes the buckets of its best axes in several
tables; what it finds there is ranked by exact inner products.

Directions say little of inner products where lengths differ, so rows are taken in bands of nearly equal length. In a
band of many rows the largest products are at small angles and the tables find them; a band of few rows, where they
need not be, is scanned. Queries with fewer answers than asked for, or with one of no positive product, for which small
angles say nothing, pass over all rows of their width.

Every row is in the index. The index is dealt into blocks by a hash of the vector, each with all tables of its own
rows, so no bucket, however common, meets in one task; queries visit the blocks in blocks of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.frames import keep, small

TABLES = 6
PROBES = 0.2  # share of a table's buckets that a query looks into
ROUNDS = 3
SEED = 11
INDEX_BLOCK = 4096
QUERY_BLOCK = 1024
STRIP = 128  # queries scored at once
BANDS = 4  # bands of length in each doubling
SCANNED = 25  # a band of fewer rows than this times k is scanned, not hashed


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, scaled to keep lengths; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def rotations(x: np.ndarray, table: int) -> np.ndarray:
    """The rows of ``x`` under the pseudo-rotation of a table."""
    signs = np.random.default_rng([SEED, table, x.shape[1]]).choice([-1.0, 1.0], (ROUNDS, x.shape[1]))
    for row in signs:
        x = hadamard(x * row)
    return x


def padded(x: np.ndarray) -> np.ndarray:
    """The directions of the rows: unit vectors, with zeros up to a power of two above their width."""
    n, width = x.shape
    out = np.zeros((n, 1 << width.bit_length()))
    out[:, :width] = x / np.abs(x).max(1, keepdims=True)  # no square of a tiny or huge component is lost
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def bucket_of(x: np.ndarray, table: int) -> np.ndarray:
    """The nearest signed axis of each row: the axis, plus the width if it points the other way."""
    y = rotations(x, table)
    axis = np.abs(y).argmax(1)
    return axis + x.shape[1] * (y[np.arange(len(y)), axis] < 0)


def probed(x: np.ndarray, table: int, share: float) -> np.ndarray:
    """For each row and bucket whether the row probes it: the ``share`` of signed axes nearest to the row."""
    y = rotations(x, table)
    both = np.concatenate([y, -y], 1)
    count = max(1, round(share * both.shape[1]))
    best = np.argpartition(-both, count - 1, axis=1)[:, :count]
    out = np.zeros(both.shape, bool)
    np.put_along_axis(out, best, True, 1)
    return out


def best_in_block(
    index: np.ndarray, keys: np.ndarray, always: np.ndarray, queries: np.ndarray, k: int, tables: int, share: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, index position, score) of at most ``k`` best candidates of each query in a block of the index.

    Rows that ``always`` holds for are candidates of every query. Ties go to the smaller of ``keys``.
    """
    index, queries = index.astype(float), queries.astype(float)
    hashed = not always.all()
    if hashed:
        padded_index, padded_queries = padded(index), padded(queries)
        buckets = [bucket_of(padded_index, t) for t in range(tables)]
    found = []
    for low in range(0, len(queries), STRIP):
        strip = slice(low, low + STRIP)
        candidate = np.tile(always, (len(queries[strip]), 1))
        for t in range(tables if hashed else 0):
            candidate |= probed(padded_queries[strip], t, share)[:, buckets[t]]
        scores = np.where(candidate, queries[strip] @ index.T, -np.inf)
        if k < len(index):
            least = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
            candidate &= scores >= least
        row, column = np.nonzero(candidate)
        score = scores[row, column]
        order = np.lexsort((keys[column], -score, row))
        row, column, score = row[order], column[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        chosen = place < k
        found.append((row[chosen] + low, column[chosen], score[chosen]))
    return tuple(np.concatenate(part) for part in zip(*found))


def usable(vector: Column) -> Column:
    """Whether a vector takes part: some component, none null or non-finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def log_length(vector: Column) -> Column:
    """The binary logarithm of a vector's length; the largest component is taken out first, so that no square is lost."""
    top = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))

    def squares(most: Column) -> Column:
        return F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x.cast("double") / most) * (x.cast("double") / most))

    # A lambda's variable is computed once, where a column would be for every component.
    return F.get(F.transform(F.array(top), lambda most: F.log2(most) + F.log2(squares(most)) / 2), 0)


def nearest(
    df: DataFrame, key: str, vector: str, is_query: Column, k: int = 20, tables: int = TABLES, share: float = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row that ``is_query`` holds for.

    Nearest is the largest inner product, in double precision; ties go to the smaller key. A query's own key is no
    answer to it. Rows with a null key, or a vector that is null, empty, zero or has null or non-finite components,
    take no part; vectors of different widths never meet. Equal vectors are one class in the index and keep their
    ``k`` + 1 smallest keys, which is all that any answer can name, so copies cost nothing. A query of a width with no
    more than ``k`` other rows gets them all, every other query ``k``. An empty frame gives none. Other columns are not
    looked at.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    smallest = Window.partitionBy("v").orderBy("id")
    classes = keep(
        rows.select("id", "v").distinct().withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .select(F.monotonically_increasing_id().alias("name"), F.col("ids")[0].alias("least"), "ids", "v",
                F.size("v").alias("width"), F.floor(log_length(F.col("v")) * BANDS + 0.5).alias("band"))
    )
    asking = keep(rows.where("asks").select("id", "v").distinct().join(classes.select("name", "v"), "v").select("id", "name", "v"))
    bands = keep(classes.groupBy("width", "band").agg(F.count(F.lit(1)).alias("n")))
    asked = asking.select("name", "v").distinct()
    blocks = (bands.agg(F.sum("n").alias("n")).first()["n"] or 0) // INDEX_BLOCK + 1
    strips = asked.count() // QUERY_BLOCK + 1
    scanned = small(bands.select("width", "band", (F.col("n") < SCANNED * k).alias("always")))

    def dealt(name: str, count: int) -> Column:
        # Of the same type as the numbers of a sequence, or equal numbers would be dealt to different tasks.
        return F.pmod(F.xxhash64(name), F.lit(count)).cast("int")

    index = classes.join(scanned, ["width", "band"]).select(
        "name", "least", "v", "width", "always", dealt("name", blocks).alias("block"))

    def search(held: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if held.empty or asks.empty:
            return pd.DataFrame({"name": [], "found": [], "least": [], "score": []})
        least = held["least"].to_numpy()
        asker, found, score = best_in_block(
            np.stack(held["v"].to_numpy()), least, held["always"].to_numpy(bool), np.stack(asks["v"].to_numpy()), k + 1, tables, share)
        return pd.DataFrame({"name": asks["name"].to_numpy()[asker], "found": held["name"].to_numpy()[found],
                             "least": least[found], "score": score})

    together = ["width", "block", "strip"]
    best = Window.partitionBy("name").orderBy(F.desc("score"), "least")

    def met(index: DataFrame, asked: DataFrame, strips: int) -> DataFrame:
        """(name, score, vec_id): the best of all blocks for each asking class, as many as answers can name."""
        index = index.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
        searching = asked.select(F.col("name").alias("name"), F.col("v").alias("v"), F.size("v").alias("width"), dealt("name", strips).alias("strip"),
                                 F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        found = (
            index.groupBy(*together).cogroup(searching.groupBy(*together))
            .applyInPandas(search, "name long, found long, least long, score double")
            .withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
        )
        return (
            found.join(classes.select(F.col("name").alias("found"), "ids"), "found")
            .select("name", "score", F.explode("ids").alias("vec_id"))
            .withColumn("n", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("score"), "vec_id")))
            .where(F.col("n") <= k + 1).select("name", "score", "vec_id")
        )

    named = keep(met(index, asked, strips))
    enough = named.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last")).where(
        (F.col("n") > k) & (F.col("last") > 0))
    left = keep(asked.join(enough, "name", "left_anti"))
    again = left.count()
    if again:
        whole = met(index.withColumn("always", F.lit(True)), left, again // QUERY_BLOCK + 1)
        named = named.join(left.select("name"), "name", "left_anti").unionByName(whole)
    answer = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asking.select(F.col("id").alias("query_id"), "name").distinct().join(named, "name").where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(answer)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def recall(spark_found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact answers (query_id, vec_id) that were found."""
    hits = exact.join(spark_found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hits / max(1, exact.count())

