"""Exact totals and quantiles of groups of any size, without holding a group in one place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Numbers below the first limit are buckets of their own; from each limit on, eight more bits are
# cleared, so that a bucket is told by eight to sixteen leading bits.
BUCKET_LIMITS = tuple(1 << bits for bits in range(16, 63, 8))


def _bucket(value: str) -> Column:
    """The number with its low bits cleared; truncating towards zero keeps the order."""
    size = F.abs(F.col(value))
    low_bits = F.lit((1 << 8 * len(BUCKET_LIMITS)) - 1)
    for i in reversed(range(len(BUCKET_LIMITS))):
        low_bits = F.when(size < BUCKET_LIMITS[i], F.lit((1 << 8 * i) - 1)).otherwise(low_bits)
    sign = F.when(F.col(value) < 0, F.lit(-1)).otherwise(F.lit(1))
    # Never null, so that joining on it adds no filter and both uses of the counts stay one exchange.
    return F.coalesce(F.col(value) - sign * size.bitwiseAND(low_bits.cast("bigint")), F.lit(0))


def exact_summary(
    rows: DataFrame, by: Sequence[str], value: str, wanted: Mapping[str, float]
) -> DataFrame:
    """n, sum (decimal), max and interpolated quantiles of a bigint column per group.

    Equal values are counted in the map tasks, and everything else works on those counts, which
    Spark exchanges once. Counts per bucket (a few thousand per power of two) tell which buckets hold
    the wanted ranks; only their values are ranked. Rows with a null key or value do not count.
    """
    counted = (
        rows.dropna(subset=[*by, value])
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", _bucket(value))
    )
    weighted = F.col(value).cast("decimal(19,0)") * F.col("_n").cast("decimal(19,0)")
    group = Window.partitionBy(*by)
    totals = F.struct(
        F.sum("_bn").over(group).alias("n"),
        F.sum("_bsum").over(group).alias("sum"),
        F.max("_bmax").over(group).alias("max"),
    )
    buckets = (
        counted.groupBy(*by, "_bucket")
        .agg(F.sum("_n").alias("_bn"), F.sum(weighted).alias("_bsum"), F.max(value).alias("_bmax"))
        .withColumns({"_end": F.sum("_bn").over(group.orderBy("_bucket")), "_all": totals})
        .withColumn("_begin", F.col("_end") - F.col("_bn"))
    )
    ranks = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                ((F.col("_all.n") - 1) * F.lit(float(q))).alias("at"),
                F.col("_all").alias("all"),
            )
            for name, q in wanted.items()
        ]
    )
    lo, hi = F.floor("_want.at"), F.ceil("_want.at")
    # A wanted position lies between two ranks, which may sit in two buckets.
    hits = buckets.withColumn("_want", F.explode(ranks)).filter(
        (hi >= F.col("_begin")) & (lo < F.col("_end"))
    )
    needed = hits.groupBy(*by, "_bucket").agg(
        F.min("_begin").alias("_begin"), F.collect_set("_want").alias("_wants")
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(value)
    ranked = counted.join(needed, [*by, "_bucket"]).withColumn(
        "_to", F.col("_begin") + F.sum("_n").over(inside)
    )

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_to") - F.col("_n")) & (rank < F.col("_to"))

    ends = ranked.withColumn("_want", F.explode("_wants")).filter(holds(lo) | holds(hi))
    found = ends.groupBy(*by, "_want").agg(
        F.max(F.when(holds(lo), F.col(value))).alias("_lo"),
        F.max(F.when(holds(hi), F.col(value))).alias("_hi"),
    )
    share = F.col("_want.at") - lo
    found = found.withColumn("_q", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share)
    return found.groupBy(*by).agg(
        *[F.max(F.col(f"_want.all.{c}")).alias(c) for c in ("n", "sum", "max")],
        *[F.max(F.when(F.col("_want.name") == name, F.col("_q"))).alias(name) for name in wanted],
    )
