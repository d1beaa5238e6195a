"""Facts about a group on each of its rows, without gathering the group in one task.

A window over the group key puts a hot group into a single task. Here the facts come from a partial
aggregation, which shrinks every group inside the map tasks, and they return to the rows by a join on
(key, salt): a hot group is spread over as many tasks as there are salts. A group's facts are
repeated only for the salts that its rows really have.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 256
#: Of lookups, which are repeated for each.
LOOKUP_SALTS = 32
#: What a row of a broadcast takes besides its texts.
ROW_BYTES = 64


def salted(rows: DataFrame, spread_on: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Add `_salt`, a stable number below `salts` that depends on the row."""
    return rows.withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_on), F.lit(salts).cast("bigint")).cast("int")
    )


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join by columns of one name where null equals null; the left's columns stay."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    joined = left.join(other, condition, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def attach_group_facts(
    rows: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column],
    spread_on: Sequence[str],
    members: Column | None = None,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join the aggregates of each group to its rows.

    `members` limits the rows that count. `refine` may filter or extend the facts (one row per
    group); rows of groups that it drops get nulls, or drop out with `how="inner"`.
    """
    spread = salted(rows, spread_on, salts)
    counted = spread if members is None else spread.filter(members)
    facts = counted.groupBy(*keys).agg(*aggs, F.collect_set("_salt").alias("_salts"))
    if refine is not None:
        facts = refine(facts)
    facts = facts.withColumn("_salt", F.explode("_salts")).drop("_salts")
    return join_null_safe(spread, facts, [*keys, "_salt"], how).drop("_salt")


def broadcast_limit(spark: SparkSession) -> int:
    """The session's limit for broadcasts, in bytes."""
    told = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?[0-9]+)([kmgtp]?)i?b?", told).groups()
    return int(number) << (10 * "kmgtp".index(unit) + 10 if unit else 0)


def held_bytes(rows: DataFrame) -> int:
    """About the bytes that rows of plain columns take in memory, whatever a file packs them into."""
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in rows.columns]
    one = sum(texts, F.lit(ROW_BYTES)).cast("bigint")
    return rows.agg(F.coalesce(F.sum(one), F.lit(0))).first()[0]


def salted_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    how: str,
    salts: int = LOOKUP_SALTS,
) -> DataFrame:
    """Join rows to a lookup with one row per key, read twice, so better a written one.

    A lookup that is within the broadcast limit when it is held in memory goes to all tasks, once. A larger
    one is repeated for each salt, or for those in its column `_salts`, which a key's rows really have, and is
    never broadcast: its file and the planner's estimate may be a small part of what it takes. A hot key's
    rows spread over `salts` tasks.
    """
    named = lookup.drop("_salts")
    if held_bytes(named) <= broadcast_limit(rows.sparkSession):
        return join_null_safe(rows, F.broadcast(named), keys, how)
    own = F.col("_salts") if "_salts" in lookup.columns else F.sequence(F.lit(0), F.lit(salts - 1))
    repeated = lookup.withColumn("_salt", F.explode(own)).drop("_salts").hint("merge")
    return join_null_safe(salted(rows, spread_on, salts), repeated, [*keys, "_salt"], how).drop("_salt")
