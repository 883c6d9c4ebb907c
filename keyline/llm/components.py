"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyline.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) of the nodes of ``edges(a, b)``.

    Each step points neighbours at the least node known, first those above a node, then
    those below; the number of steps grows with the logarithm of the longest path. A hub
    is a minimum per node (aggregated before the shuffle) and a join, never a collected
    list. Loops and repeated edges are ignored; an empty table gives an empty result.
    """
    e = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    before = None
    while True:
        both = e.select(F.col("v").alias("x"), F.col("u").alias("y")).union(e.select("u", "v"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u"))
        large = large.filter("v <> u").distinct()
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(down, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).union(down.select("v", F.col("m").alias("u")))
        e = materialize(small.filter("v <> u").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = e.groupBy("v").agg(F.min("u").alias("component")).select(F.col("v").alias("node"), "component")
    centres = e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return stars.unionByName(centres.join(stars.select("node"), "node", "left_anti"))
