"""Connected components by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailymart.llm.store import saved


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("b", "a")).toDF("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for links ``(a, b)``: the smallest node reachable from each linked node.

    Alternates large and small stars: every node hands its larger (smaller) neighbours to the smallest
    one it knows, until only stars around the smallest nodes are left. Each step is one aggregate and
    one join, so nothing is gathered per component; a node in many links is split like any skewed key.
    """
    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    links = saved(links, "links")
    while True:
        both = _neighbours(links)
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(lowest, "a").select("low", "b").toDF("a", "b").distinct()
        lowest = large.groupBy("b").agg(F.min("a").alias("low"))
        small = (
            large.join(lowest, "b")
            .select(F.explode(F.array(F.struct("low", "b"), F.struct(F.col("low"), F.col("a").alias("b")))).alias("e"))
            .select(F.col("e.low").alias("a"), F.col("e.b").alias("b"))
            .where("a < b")
            .distinct()
        )
        after = saved(small, "links")
        # Stars only: nobody has two centres, and no centre is a leaf of another one.
        leaves, centres = after.select("b"), after.select("a").distinct()
        done = after.count() == leaves.distinct().count() and centres.join(leaves, centres.a == leaves.b).isEmpty()
        links = after
        if done:
            break
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        links.select("a", "a").distinct()
    )
