"""Connected components of an edge list by alternating large-star and
small-star steps: every step is a grouped minimum (summed up in the map tasks,
so the edges of a hub never meet in one task) and a join back to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import materialise


def _settled(pairs: DataFrame) -> bool:
    """Whether the pairs (u, v) are stars: no u twice, no v that is a u too."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in_")).union(
        pairs.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.sum("in_").alias("in_")).where(
        "out > 1 or out = 1 and in_ > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: bigint) -> rows (node, component): the least node that
    each node with an edge is linked with, over any number of edges."""
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .where("u != v").distinct(), "edges")
    while not _settled(now):
        # large star: the larger neighbours of a node are linked to the least
        # of the node and its neighbours
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")), "least")
        large = materialise(both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large")
        # small star: a node and its smaller neighbours to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(linked.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "small")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct())
