"""Numbered packets of sessions: release them in order and report gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedkit.plans.ordered import number_gaps, unbroken_prefix
from feedkit.plans.settle import settle
from feedkit.plans.skew import SALTS, attach_group_facts, salted_lookup

SESSION = "socket_id"


def numbered_packets(packets: DataFrame, number: str = "n") -> tuple[DataFrame, DataFrame]:
    """(ok, rejects): packets need a session id and a whole number that is not negative."""
    n = F.col(number).cast("string")
    parsed = F.when(n.rlike(r"^[0-9]+$"), n.try_cast("bigint"))
    marked = packets.withColumn(number, parsed)
    ok = (F.coalesce(F.col(SESSION), F.lit("")) != "") & F.col(number).isNotNull()
    return marked.filter(ok), packets.filter(
        ~((F.coalesce(F.col(SESSION), F.lit("")) != "") & parsed.isNotNull())
    )


def sequence_release(
    packets: DataFrame, order: str = "arrival", parts: int | None = None, salts: int = SALTS
) -> DataFrame:
    """Packets of each session's unbroken prefix, up to its end mark.

    A packet is released at the running maximum of the first arrivals of 1..n (`released_at`); the
    copy that counts is the last one that had arrived by then. All other packets wait or are
    repeats, and do not come out.
    """
    release = release_plan(packets.select(SESSION, "n", "op", order), order, parts, salts)
    chosen = packets.join(release.drop("op"), [SESSION, "n", order])
    # Copies that arrived at one time: the packet comes out once, preferably its end mark.
    tie = Window.partitionBy(SESSION, "n", order).orderBy(
        (F.col("op") != "EOF").cast("int"), "op", F.xxhash64(*packets.columns)
    )
    return chosen.withColumn("_nth", F.row_number().over(tie)).filter("_nth = 1").drop("_nth")


def release_plan(
    packets: DataFrame, order: str = "arrival", parts: int | None = None, salts: int = SALTS
) -> DataFrame:
    """Which copy of each packet is released, and when: no payload moves here.

    The narrow result is used twice, so it is written once.
    """
    key = [SESSION, "n"]

    def released(firsts: DataFrame) -> DataFrame:
        prefix = unbroken_prefix(firsts, [SESSION], "n", F.col("_first"), parts)
        return prefix.withColumnRenamed("running_max", "released_at").drop("_first")

    copies = attach_group_facts(
        # A packet without an arrival has not arrived: those behind it wait.
        packets.select(*key, "op", order).dropna(subset=[*key, order]),
        key,
        [F.min(order).alias("_first")],
        spread_on=[*key, order],
        refine=released,
        how="inner",
        salts=salts,
    ).filter(F.col(order) <= F.col("released_at"))
    chosen = copies.groupBy(*key, "released_at").agg(
        F.max(order).alias(order),
        F.max_by("op", F.struct(F.col(order), F.col("op") == "EOF", F.col("op"))).alias("op"),
    )
    chosen = settle(chosen, "released")
    ends = chosen.filter(F.col("op") == "EOF").groupBy(SESSION).agg(F.min("n").alias("_end"))
    ends = settle(ends, "ends")
    return (
        salted_lookup(chosen, ends, [SESSION], ["n"], "left")
        .filter(F.col("_end").isNull() | (F.col("n") <= F.col("_end")))
        .drop("_end")
    )


def sequence_gaps(packets: DataFrame, parts: int | None = None, order: str = "arrival") -> DataFrame:
    """Ranges of packet numbers that each session still waits for: socket_id, from_n, to_n."""
    arrived = packets.filter(F.col(order).isNotNull()) if order in packets.columns else packets
    return number_gaps(arrived.filter(F.col("n") >= 1), [SESSION], "n", parts)
