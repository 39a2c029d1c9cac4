"""Connected components by alternating large-star and small-star steps.

Every round is two joins/aggregations over edge rows; edges stay in Spark, only
a count per round reaches the driver.  A hub's edges are never gathered: each
step needs the minimum neighbour of a node, which pre-aggregates map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Link the larger (else the smaller-or-equal) neighbours of each node to the
    least of its neighbours and itself; pairs (u, v) are given per centre u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    linked = pairs.join(least, "u")
    if large:
        return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (u, v): the least node reachable."""
    now = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"),
                                               F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, True).filter("u != v").distinct()
        small = _star(large, False).filter("u != v").distinct()
        now = stored(small, "edges")
        # at the fixed point every edge joins a node to its least: count and checksum stay
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
