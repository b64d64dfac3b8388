"""Connected components of a distributed edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node of ``edges`` (a, b: undirected): node, root.

    Nodes that are in no edge to another node aren't listed; null ends, loops and repeated edges count as none.
    Every round hangs each node's larger neighbours, then its smaller ones, onto the smallest; the number of edges
    never grows, a hub is only ever grouped with partial sums, and the edges are written down each round.
    """
    e = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    e = materialize(e, "edges")
    before = _state(e)
    while before[0]:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        old, e = e, materialize(small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
        discard(old, large)
        now = _state(e)
        if now == before:
            break
        before = now
    roots = e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
