"""Connected components of an edge table, by alternating large and small stars.

Every round is a grouping and a join on node ids; Spark combines the minima before shuffling,
so a node with very many edges is no burden, and adaptive execution splits its join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    code = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(code)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (u, v); the component is its least node.

    Direction, repeats, loops and rows with nulls do not matter. A loop alone makes no node.
    """
    one = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = cut_lineage(one.distinct())
    before = _state(now)
    while before[0]:
        # Large star: all larger neighbours of a node point to the least of its neighbourhood.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: the smaller neighbours of a node, and itself, point to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = cut_lineage(small)
        after = _state(now)
        if after == before:
            break
        before = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
