"""Mixing sources to target weights along a curriculum.

Targets: sources in code point order (null last) take weights from a cycle and share a multiple of
all words; a target stops at `cap` times its source, and what it leaves is shared again by weight.
That level is found with two sums over the sources per round, so their number may grow.

Takes: a source's documents are laid out in the order of a hash of their id. Whole passes over the
source come first, then its target ends inside a further pass; the one document there is cut.

Curriculum: a source's weight changes over training time t in [0, 1] along a ramp of mean 1,
`1 + slope * (2t - 1)`. Its integral says which part of the target is due by t; inverted at the words
laid out before a document, it gives the document's position for each pass. Range-sorting by
position gives the training order.

Running sums go over (source, hash range) groups of bounded size, with one total per group carried
over, so a source with a third of all rows spreads over all tasks.

Null texts and texts without words have size 0 and are taken with 0 words; repeated rows are
documents of their own; sources without words get target 0; an empty table gives no rows; columns
other than doc_id, text and source are not read. Reruns give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedkit.plans.settle import settle

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: From a source that fades out to one that comes late.
SLOPES = (-0.5, 0.0, 0.5)
#: Rows of one source in a hash range, and the most ranges.
RANGE_ROWS, RANGES = 512, 65_536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sources: DataFrame,
    share: float = 1.5,
    cap: float = 2.0,
    weights: Sequence[float] = WEIGHTS,
    slopes: Sequence[float] = SLOPES,
) -> DataFrame:
    """`sources` (source, source_size; one row each) with `target` and `slope`."""
    keyed = sources.withColumn("_none", F.col("source").isNull())
    dealt = keyed.repartitionByRange("_none", "source").withColumn("_part", F.spark_partition_id())
    dealt = settle(dealt, "sources")
    parts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_none", "source")
    nth = F.row_number().over(inside) - 1 + F.col("_before")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ramps = F.array(*[F.lit(float(s)) for s in slopes])
    ranked = dealt.join(parts, "_part").withColumn("_nth", nth)
    ranked = ranked.select(
        "source",
        "source_size",
        F.get(cycle, F.col("_nth") % len(weights)).alias("_weight"),
        F.get(ramps, F.col("_nth") % len(slopes)).alias("slope"),
    )
    ranked = settle(ranked, "weights")
    most = F.col("source_size") * F.lit(cap)
    totals = ranked.agg(F.sum("source_size"), F.sum("_weight")).first()
    budget = share * (totals[0] or 0)
    level = budget / totals[1] if totals[1] else 0.0
    while True:  # the level only rises, and ends when no further source stops
        stops = most <= F.col("_weight") * F.lit(level)
        stopped, free = ranked.agg(
            F.sum(F.when(stops, most)), F.sum(F.when(~stops, F.col("_weight")))
        ).first()
        raised = (budget - (stopped or 0.0)) / free if free else level
        if raised <= level:
            break
        level = raised
    target = F.least(most, F.col("_weight") * F.lit(level))
    return ranked.select("source", "source_size", target.alias("target"), "slope")


def _position(done: Column, slope: Column) -> Column:
    """The time at which the part `done` of a target is due."""
    root = F.sqrt(F.greatest((1 - slope) * (1 - slope) + 4 * slope * done, F.lit(0.0)))
    late = 2 * done / (1 - slope + root)  # the stable form of the quadratic's root
    return F.least(F.greatest(F.when(done <= 0, F.lit(0.0)).otherwise(late), F.lit(0.0)), F.lit(1.0))


def mix(docs: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """Per document: key, size, source, source_size, target, taken, positions.

    `positions` has an element for each pass that takes words of the document.
    """
    rows = docs.select(F.col(key).alias(key), "source", word_count(F.col("text")).alias("size"))
    rows = settle(rows.withColumn("_h", F.xxhash64(F.col(key), F.lit(7))), "sizes")
    count = rows.count()
    ranges = 1
    while ranges < min(RANGES, count / RANGE_ROWS):
        ranges *= 2
    # Hash ranges in ascending order of the hash, read as a signed number.
    shifted = F.shiftrightunsigned(F.col("_h").bitwiseXOR(F.lit(-(2**63)).cast("bigint")), 44)
    rows = rows.withColumn("_range", F.shiftright(shifted * ranges, 20).cast("int"))
    rows = rows.withColumn("_none", F.col("source").isNull())
    rows = rows.withColumn("_source", F.coalesce("source", F.lit("")))

    own = ["_none", "_source"]
    groups = rows.groupBy(*own, "_range").agg(F.sum("size").alias("_size"))
    groups = settle(groups, "ranges")
    sources = groups.groupBy(*own).agg(F.sum("_size").alias("source_size"))
    sources = sources.select(F.when(~F.col("_none"), F.col("_source")).alias("source"), "source_size")
    facts = source_targets(sources, **how)
    facts = facts.withColumn("_none", F.col("source").isNull())
    facts = facts.withColumn("_source", F.coalesce("source", F.lit(""))).drop("source")
    before = Window.partitionBy(*own).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    groups = groups.drop("_size").join(facts, own)

    joined = rows.join(groups, [*own, "_range"])
    inside = Window.partitionBy(*own, "_range").orderBy("_h", key, "size")
    laid = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = joined.withColumn("_at", F.col("_before") + laid - F.col("size"))

    whole = F.round("target").cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0)
    # Exact even where the quotient of two long numbers rounds up.
    passes = F.when(passes * F.col("source_size") > whole, passes - 1).otherwise(passes)
    joined = joined.withColumn("_passes", passes.cast("bigint"))
    extra = whole - F.col("_passes") * F.col("source_size")
    more = F.least(F.greatest(extra - F.col("_at"), F.lit(0)), F.col("size"))
    joined = joined.withColumn("taken", F.col("_passes") * F.col("size") + more)
    turns = F.when(
        F.col("taken") > 0,
        F.sequence(F.lit(0).cast("bigint"), F.col("_passes") - F.when(more > 0, 0).otherwise(1)),
    ).otherwise(F.array().cast("array<bigint>"))
    positions = F.transform(
        turns,
        lambda k: _position((F.col("_at") + k * F.col("source_size")) / F.col("target"), F.col("slope")),
    )
    return joined.select(
        key, "size", "source", "source_size", "target", "taken", positions.alias("positions")
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """Documents by the position of their first pass; those not taken come last."""
    first = F.coalesce(F.get("positions", F.lit(0)), F.lit(2.0))
    return mixed.withColumn("_first", first).repartitionByRange("_first", "doc_id").sortWithinPartitions("_first", "doc_id").drop("_first")


def _twins(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Number rows of one key, source and size; adds these without nulls."""
    own = {
        "_k": F.coalesce(key, F.lit(0)),
        "_no_k": F.col(key).isNull(),
        "_s": F.coalesce("source", F.lit("")),
        "_no_s": F.col("source").isNull(),
    }
    same = Window.partitionBy(*own, "_size").orderBy(*order)
    return rows.withColumns(own).withColumn("_twin", F.row_number().over(same))


def drawn(docs: DataFrame, mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of `docs`, columns as they are, once for each pass that takes them, by position.

    The one document of a source that a pass takes in part keeps its first words, with single spaces.
    """
    # Whole rows travel in one column, so their names meet no others.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.select("_row", F.col("_row")[key].alias(key), F.col("_row.source").alias("source"))
    rows = rows.withColumn("_size", word_count(F.col("_row.text")))
    rows = _twins(rows, key, [F.xxhash64("_row.text")])
    taken = mixed.select(key, "source", F.col("size").alias("_size"), "taken", "positions")
    taken = _twins(taken, key, [F.col("positions")]).withColumnRenamed("_twin", "_other")
    on = ["_k", "_no_k", "_s", "_no_s", "_size"]
    taken = taken.filter("taken > 0").select(*on, "_other", "taken", "positions")
    # The twins' numbers are compared after the join, so that rows move once.
    met = rows.join(taken, on).filter("_twin - _other = 0")
    met = met.select(
        key,
        "_row",
        (F.col("taken") % F.col("_size")).alias("_last"),
        F.size("positions").alias("_passes"),
        F.posexplode("positions").alias("_nth", "_position"),
    )
    words = F.regexp_extract_all(F.col("_row.text"), F.lit(f"({WORD})"), F.lit(1))
    cut = (F.col("_last") > 0) & (F.col("_nth") == F.col("_passes") - 1)
    text = F.when(cut, F.array_join(F.slice(words, 1, F.col("_last").cast("int")), " "))
    met = met.withColumn("_text", F.coalesce(text, F.col("_row.text")))
    met = met.repartitionByRange("_position", key).sortWithinPartitions("_position", key)
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return met.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
