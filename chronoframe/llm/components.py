"""Connected components of a table of links, without collecting links or components.

Each round alternates two steps over the links, as a forest of stars: every node's greater neighbours are
linked to its least neighbour (large star), then its lesser neighbours and itself are (small star).  Both are a
grouped minimum with map-side combine and a join back, so a node with very many links is pre-aggregated and
its joined rows can be split.  Rounds end when the links stay the same; their number grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(links: DataFrame) -> DataFrame:
    """One large star and one small star over links ``a > b``."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").select(F.col("b").alias("x"), F.col("m").alias("y")).where("x <> y")
    return small.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (least node that can be reached) of every node with a link to another."""
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    now = materialize(now, "links")
    mark = None
    while True:
        now = materialize(_star(now), "links")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
