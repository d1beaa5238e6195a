"""Meter a feed: size buckets, periodic reports, and upstream samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POWERS_OF_TEN = tuple(10**p for p in range(1, 13))


def size_histogram(
    metrics: DataFrame, bounds: Sequence[int] = POWERS_OF_TEN, by: Sequence[str] = ("host", "action")
) -> DataFrame:
    """Files per size bucket; bucket k holds sizes with exactly k bounds at or below them."""
    steps = [(F.col("size") >= F.lit(b)).cast("int") for b in bounds]
    bucket = reduce(lambda a, b: a + b, steps, F.lit(0))
    files = F.sum("files") if "files" in metrics.columns else F.count(F.lit(1))
    return metrics.groupBy(*by, bucket.alias("bucket")).agg(files.alias("n"))


def feed_metrics(
    metrics: DataFrame, every: str = "5 minutes", by: Sequence[str] = ("host", "action")
) -> DataFrame:
    """Files and bytes per host, action and period."""
    return (
        metrics.groupBy(F.window("ts", every).alias("_w"), *by)
        .agg(F.sum("files").alias("files"), F.sum("size").alias("bytes"))
        .select(F.col("_w.start").alias("period_start"), *by, "files", "bytes")
    )


def merge_metrics(
    local: DataFrame, upstream: DataFrame, pass_through: bool = True, every: str = "5 minutes"
) -> tuple[DataFrame, DataFrame]:
    """(report, forwarded): upstream samples always count; they go on unless held back."""
    report = feed_metrics(local.unionByName(upstream), every)
    return report, upstream if pass_through else upstream.filter(F.lit(False))
