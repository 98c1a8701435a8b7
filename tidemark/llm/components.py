"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``(a, b)``; the root is the smallest node of the component.

    Alternates large-star and small-star steps until the edges no longer
    change; each step is one grouping that combines before its shuffle, and its
    result is a table. A star's centre keeps its edges as rows, so no group is
    gathered. Nodes may be of any orderable type.
    """
    pairs = edges.where("a != b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()
    nodes = saved(pairs, "components")
    state = None
    while True:
        both = nodes.select(F.col("low").alias("v"), F.col("high").alias("u")).unionByName(
            nodes.select(F.col("high").alias("v"), F.col("low").alias("u")))
        # Large star: larger neighbours hang under the smallest neighbour (or the node itself).
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("m").alias("low"), F.col("u").alias("high")).distinct()
        large = saved(large.where("low != high"), "components")
        # Small star: smaller neighbours, and the node, hang under the smallest of them.
        lowest = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(lowest, "high").select(
            F.col("m").alias("low"), F.explode(F.array("low", "high")).alias("high")).where("low != high").distinct()
        nodes = saved(small, "components")
        now = nodes.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")).alias("s")).first()
        if now == state:
            break
        state = now
    return nodes.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        nodes.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
