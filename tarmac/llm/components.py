"""Connected components by alternating large and small stars.

Each round is aggregations and joins over the edges alone, checkpointed in the shared folder; the driver only learns a
count and a checksum. A node with very many edges is combined before the shuffle, and its rows in the join are split at
run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.text import cut


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest node it knows."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them. Edges go from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node with an edge; the root is the smallest node of its component. Edges a-b, any order.

    Nodes are of any type that has an order.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while state[0]:
        now = cut(_small(_large(now)))
        before, state = state, _state(now)
        if state == before:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(now.select("b", "b").distinct())
