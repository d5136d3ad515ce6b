"""Connected components of an edge table by alternating star contraction.

Large-star links every node's greater neighbours to its least neighbour;
small-star links a node's lesser neighbours and itself to the least.  Rounds go on
until the edges stand still, which takes about log(n) rounds.  Least neighbours
are map-side aggregates; what meets them in an equi-join may have a hot key, which
AQE splits.  Nothing but one checksum a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import written


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), any order, of any sortable type -> (node, component): the least
    node reachable.  Nodes without edges do not appear."""
    e = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    mark = _mark(e)
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")  # u > v
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
        e = written(small.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct(), "small-star")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    stars = e.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
