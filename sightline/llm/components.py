"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored


def _star(links: DataFrame, small: bool) -> DataFrame:
    """links: (u, v), u > v.  Links every neighbour of a node (small: only itself and smaller ones) to
    the least of them; a map-side combined minimum, then a join whose hot keys Spark can split."""
    both = links if small else links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
    near = both.join(least, "u")
    moved = near.filter("v > m" if small else "v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # the node itself stays reachable through its least neighbour
    moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    out = stored(moved.filter("u > v").distinct(), "star")
    forget(least, links)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's component.  links: (a, b) in any order; nodes
    without a link don't appear.  Every round is written, so a lost executor repeats one round, and the
    round before is deleted; the rounds grow with the logarithm of the nodes."""
    links, before = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"), None
    while True:
        links = _star(_star(links, small=False), small=True)
        # equal sums over the links of two rounds: nothing moved
        now = tuple(links.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())
        if now == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now
