"""Connected components of a link table by alternating large-star and small-star steps; nothing reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    pairs = _both_ways(edges)
    # Written first, so the join deals a crowded node's rows anew instead of leaving them where they were aggregated.
    least = cut(pairs.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("least", "u")), "least")
    return pairs.filter("v > u").join(least, "u").select(F.col("least").alias("a"), F.col("v").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them; edges have a < b."""
    least = cut(edges.groupBy("b").agg(F.min("a").alias("least")), "least")
    moved = edges.join(least, "b").select(F.col("least").alias("a"), F.col("a").alias("b")).filter("a != b")
    return moved.union(least.select(F.col("least").alias("a"), "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b); component is the smallest node reachable. Steps go on until no
    link changes, which takes a number of them that grows with the logarithm of the links at most squared."""
    edges = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    sign = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    before, at = None, sign(edges)
    while at[0] and at != before:
        large = cut(_large_star(edges), "edges")
        drop(edges)
        edges = cut(_small_star(large), "edges")
        drop(large)
        before, at = at, sign(edges)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
