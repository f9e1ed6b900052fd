"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.llm import common as C


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another; root is the component's smallest node.

    Each round is written to the shared folder; edges only move towards smaller nodes, so stars remain. Joins
    are on a node, whose minimum comes from partial minima; adaptive execution splits the side of a hot node.
    """
    now = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u != v").distinct()
    now = C.materialise(now)
    mark = _mark(now)
    while True:
        both = now.union(now.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        now = C.materialise(small)
        last, mark = mark, _mark(now)
        if mark == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
