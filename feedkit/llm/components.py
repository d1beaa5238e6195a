"""Connected components of a graph whose edges are rows.

Alternating star contraction: every round hangs the neighbours of each node on the smallest of them,
first the larger ones, then the smaller ones, until no edge changes. A node's smallest neighbour comes
from a partial aggregation and returns to its edges by a join, so no node's neighbours are gathered.
Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.plans.settle import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` for every node of `edges` (a, b bigint): the smallest node it reaches."""
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = settle(edges.filter("a <> b").select(larger, smaller).distinct(), "edges")
    mark = None
    while True:
        turned = _large_star(now)
        now = settle(_small_star(turned.filter("a <> b").distinct()), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(heads)
