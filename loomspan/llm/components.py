"""Connected components of an edge table by alternating large and small stars (Kiveris et al. 2014).

Every round is a grouped minimum, combined before the shuffle, and a join of two plain tables on the same key, whose skewed partitions adaptive execution splits where a vertex
has very many edges (beside an aggregate on the key it would not, so the minima are written first); no vertex, edge or component list reaches the driver,
only two sums that tell whether a round changed anything. Edges with a null end are no edges; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Links each vertex's neighbours (large: those above it; small: those below it, and itself) to the least of them."""
    if both_ways:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = cut(near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")))
    joined = near.join(least, "u")
    if both_ways:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """v, component (the least vertex) of each vertex that has an edge. edges: u, v (longs)."""
    edges = cut(edges.select("u", "v").where("u <> v").distinct())
    before = None
    while True:
        edges = cut(_star(_star(edges, True), False))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v")).distinct().select("v", F.col("v").alias("component"))
    return edges.select(F.col("u").alias("v"), F.col("v").alias("component")).unionByName(roots)
