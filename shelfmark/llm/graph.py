"""Connected components of an edge table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, write_table


def _least(edges: DataFrame) -> DataFrame:
    """The least of each node and its neighbours."""
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def connected_components(edges: DataFrame, a: str, b: str, limit: int = 40) -> DataFrame:
    """node, component (its least node) of every node that an edge touches; edges are pairs of long. Repeated edges count
    once, edges from a node to itself or with a null are left out, and no edges give no nodes.

    Each round is two aggregates and two joins over edges, cut by a written table; rounds grow with the logarithm of
    the components' size. Aggregates keep one value a node, so a node with very many edges gathers no list; joins on
    it are split by adaptive execution.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = write_table(e, "edges")
    before = None
    for _ in range(limit):
        former = e
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = write_table(large, "large-star")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        e = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        e = write_table(e, "small-star")
        forget(large)
        forget(former)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
