"""Ordered work on long groups, as a scan in two passes over sorted pieces.

Rows are dealt by ranges of (group, order), so a piece holds an equal share of all rows, whatever the order
values are: dense numbers, nanosecond clocks, or one group that has most of them. Windows run inside a
piece of a group; what a piece needs from those before it is one row for each piece of its group, and
there are as many pieces as partitions. Only keys, orders and values come here, never payload.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.plans.settle import settle
from feedkit.plans.skew import join_null_safe


def in_pieces(rows: DataFrame, group: Sequence[str], order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Add `_piece`, the number of the range that a row lies in; it rises along a group's order.

    The rows are written once, so that all who read them see the same ranges. `parts` is the number of
    ranges, by default that of shuffle partitions. Joins with the rows are sorted ones: sorted keys make a
    small file of many rows, which the planner would take for few and broadcast.
    """
    keys = [F.col(c) for c in (*group, *order)]
    dealt = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    return settle(dealt.withColumn("_piece", F.spark_partition_id()), "pieces").hint("merge")


def runs(
    rows: DataFrame, group: Sequence[str], order: str, value: str, parts: int | None = None
) -> DataFrame:
    """Runs of equal `value` along `order`; equal orders follow by value. Null is a group like others.

    Adds `run_start`, the order value that opened the row's run, and `last_run_start`, the one of
    the group's last run.
    """
    marked = in_pieces(rows, group, [order, value], parts)
    inside = Window.partitionBy(*group, "_piece").orderBy(order, value)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_first = F.row_number().over(inside) == 1
    differs = ~F.lag(value).over(inside).eqNullSafe(F.col(value))
    marked = marked.withColumn("_opens", F.when(~is_first & differs, F.col(order)))
    marked = marked.withColumn("_opened", F.max("_opens").over(so_far)).drop("_opens")

    edges = marked.groupBy(*group, "_piece").agg(
        F.min(order).alias("_first_order"),
        F.min_by(value, F.struct(order, value)).alias("_first_value"),
        F.max_by(value, F.struct(order, value)).alias("_last_value"),
        F.max("_opened").alias("_inner"),
    )
    along = Window.partitionBy(*group).orderBy("_piece")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    continues = F.lag("_first_order").over(along).isNotNull() & F.lag("_last_value").over(
        along
    ).eqNullSafe(F.col("_first_value"))
    edges = edges.withColumn("_edge", F.when(~continues, F.col("_first_order")))
    edges = edges.withColumn("_latest", F.coalesce("_inner", "_edge"))
    edges = edges.select(
        *group,
        "_piece",
        F.coalesce("_edge", F.max("_latest").over(before)).alias("_carried"),
        F.max("_latest").over(Window.partitionBy(*group)).alias("last_run_start"),
    )
    return (
        join_null_safe(marked, edges, [*group, "_piece"])
        .withColumn("run_start", F.coalesce("_opened", "_carried"))
        .drop("_opened", "_carried", "_piece")
    )


def number_gaps(
    rows: DataFrame, group: Sequence[str], n: str, parts: int | None = None
) -> DataFrame:
    """Ranges of numbers from 1 up that are absent below each group's largest: from_n, to_n."""
    seen = in_pieces(rows.select(*group, n).distinct(), group, [n], parts)
    inside = Window.partitionBy(*group, "_piece").orderBy(n)
    seen = seen.withColumn("_prev", F.lag(n).over(inside))
    edges = seen.groupBy(*group, "_piece").agg(F.max(n).alias("_last"))
    along = Window.partitionBy(*group).orderBy("_piece")
    edges = edges.select(*group, "_piece", F.lag("_last").over(along).alias("_before"))
    prev = F.coalesce("_prev", "_before", F.lit(0))
    return (
        join_null_safe(seen, edges, [*group, "_piece"])
        .filter(F.col(n) - prev > 1)
        .select(*group, (prev + 1).alias("from_n"), (F.col(n) - 1).alias("to_n"))
    )


def unbroken_prefix(
    numbers: DataFrame, group: Sequence[str], n: str, running: Column, parts: int | None = None
) -> DataFrame:
    """Rows of each group's unbroken prefix 1..k; `numbers` has one row per (group, n).

    Adds `running_max`, the largest `running` among 1..n.
    """
    numbered = numbers.filter(F.col(n) >= 1).withColumn("_running", running)
    numbered = in_pieces(numbered, group, [n], parts)
    inside = Window.partitionBy(*group, "_piece").orderBy(n)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = numbered.withColumn("_rank", F.row_number().over(inside)).withColumn(
        "_inner_max", F.max("_running").over(so_far)
    )
    along = Window.partitionBy(*group).orderBy("_piece")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy(*group, "_piece").agg(
        F.count(F.lit(1)).alias("_size"), F.max("_running").alias("_piece_max")
    )
    sizes = sizes.select(
        *group,
        "_piece",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.max("_piece_max").over(before).alias("_carried"),
    )
    # Numbers are different and start at 1: a row is in the prefix if its rank is its number.
    return (
        numbered.join(sizes, [*group, "_piece"])
        .filter(F.col(n) == F.col("_before") + F.col("_rank"))
        .withColumn("running_max", F.greatest("_inner_max", "_carried"))
        .drop("_running", "_piece", "_rank", "_inner_max", "_before", "_carried")
    )
