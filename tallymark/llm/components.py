"""Connected components of an edge table by alternating large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(lowest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(lowest.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes that have an edge; ``edges`` has long columns a and b.

    Every round is written to the shared folder, so no round is computed twice and the plan stays short. The number
    of rounds grows with the logarithm of the longest path. The component is the smallest node.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, before = stage(now.distinct(), "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "edges")
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
