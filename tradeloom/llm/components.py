"""Connected components of a graph given by its links, as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.frames import keep

PACKED = 100_000  # links that are joined in memory at a time


def stars(edges: DataFrame) -> DataFrame:
    """(u, v): links that connect what the links (u, v) connect, at most as many.

    Of up to PACKED links of a task, each node but the smallest comes once, with the smallest that they lead to.
    """
    def smallest(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = [pa.concat_arrays([b.column(i) for b in held]).to_numpy(zero_copy_only=False) for i in (0, 1)]
        nodes, ends = np.unique(np.concatenate(columns), return_inverse=True)
        u, v = ends.reshape(2, -1)
        low = np.arange(len(nodes))
        while (low[u] != low[v]).any():
            one, other = low[u], low[v]
            near = np.minimum(one, other)
            np.minimum.at(low, one, near)
            np.minimum.at(low, other, near)
            while (low != low[low]).any():
                low = low[low]
        moved = low != np.arange(len(nodes))
        kind = held[0].schema.field(0).type
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved], kind), pa.array(nodes[low[moved]], kind)], names=["u", "v"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, PACKED):
                piece = batch.slice(start, PACKED)
                if rows + piece.num_rows > PACKED:
                    yield smallest(held)
                    held, rows = [], 0
                held.append(piece)
                rows += piece.num_rows
        if held:
            yield smallest(held)

    return edges.mapInArrow(read, edges.schema)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b): root is the smallest node that it is linked to, or itself.

    Each task first joins the links that it holds. Are at most PACKED left, they are joined at once; else by large-star
    and small-star in turn (Kiveris et al., 2014): each round points neighbours at the smallest node around, until
    every node points at its root. A round is two grouped minima and joins, which spread a node of many links over
    tasks; what a round leaves is written to the shared folder. Self-links and repeated links do no harm, nulls on
    either side are no link.
    """
    ends = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = keep(stars(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))))
    few, last = edges.count() <= PACKED, None
    if few:
        edges = keep(stars(edges.coalesce(1)))
    while not few:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lower.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
        edges = keep(small)
        # the sum of the roots' places falls until nothing moves any more
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == last:
            break
        last = state
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
