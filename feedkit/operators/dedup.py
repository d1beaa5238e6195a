"""Replace repeated content by links, resolve the links, and count what that saves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.paths import clean, dirname, join, rel
from feedkit.operators.guards import mark_links
from feedkit.plans.skew import SALTS, attach_group_facts

CONTENT_KEY = ("checksum_type", "checksum", "size")


def as_links(files: DataFrame, repeated: Column, first_path: Column) -> DataFrame:
    """Turn rows that repeat earlier content into links to it, where a relative path exists."""
    target = F.when(repeated, rel(dirname(F.col("filepath")), first_path))
    linked = files.withColumn("target", target)
    is_link = F.col("target").isNotNull()
    changed = {
        "kind": F.when(is_link, "link").otherwise(F.col("kind")),
        "orig_size": F.col("size"),
        "size": F.when(is_link, F.lit(0)).otherwise(F.col("size")).cast("bigint"),
    }
    if "content" in files.columns:
        changed["content"] = F.when(~is_link, F.col("content"))
    return linked.withColumns(changed)


def dedup_to_links(
    files: DataFrame,
    order: str = "seq",
    key: Sequence[str] = CONTENT_KEY,
    dedup: bool = True,
    salts: int = SALTS,
) -> DataFrame:
    """First copy in walk order keeps its content; later ones become links to it.

    Adds filepath, target and orig_size. Needs checksums on the rows. The comparison moves keys and
    paths only. Select the result without `content` for a plan that never moves payload; with
    `content` it moves once.
    """
    named = files.withColumn("filepath", join(F.col("path"), F.col("filename")))
    if "kind" not in files.columns:
        named = named.withColumn("kind", F.lit("file"))
    if not dedup:
        return named.withColumns(
            {"target": F.lit(None).cast("string"), "orig_size": F.col("size")}
        )
    # A missing checksum type is a type like others: the join takes null as equal to null.
    has_key = (F.col("size") > 0) & F.col("checksum").isNotNull()
    facts = attach_group_facts(
        named,
        list(key),
        [
            F.min(order).alias("_first"),
            F.min_by("filepath", order).alias("_first_path"),
            F.count(F.lit(1)).alias("_copies"),
        ],
        spread_on=[order],
        members=has_key,
        refine=lambda f: f.filter(F.col("_copies") > 1).drop("_copies"),
        salts=salts,
    )
    repeated = F.col("_first").isNotNull() & (F.col(order) != F.col("_first"))
    return as_links(facts, repeated, F.col("_first_path")).drop("_first", "_first_path")


def resolve_links(
    files: DataFrame,
    links: DataFrame,
    restore: Sequence[str] = ("size", "checksum_type", "checksum", "content"),
    spread_on: Sequence[str] = ("seq",),
    salts: int = SALTS,
) -> DataFrame:
    """Give each link the values of the file it stands for.

    `restore` names the columns of `files` to take over, prefixed `resolved_`. Adds `link_state`:
    `resolved`, `dangling` (no such file) or `unsafe` (the target leaves the feed). When several
    files have one path, the one with the lowest seq counts.
    """
    taken = [c for c in restore if c in files.columns]
    paths = files.select(clean(join(F.col("path"), F.col("filename"))).alias("resolved"), "seq")
    first = paths.groupBy("resolved").agg(F.min("seq").alias("_source_seq"))
    source = files.select(F.col("seq").alias("_source_seq"), F.struct("seq", *taken).alias("_source"))
    pointed = attach_group_facts(
        mark_links(links),
        ["resolved"],
        [],
        spread_on,
        members=F.col("link_ok"),
        # Only files that a link points to are looked up, by their number.
        refine=lambda facts: facts.join(first, "resolved").join(source, "_source_seq"),
        salts=salts,
    )
    found = F.col("link_ok") & F.col("_source").isNotNull()
    state = F.when(~F.col("link_ok"), "unsafe").when(found, "resolved").otherwise("dangling")
    result = pointed.withColumn("link_state", state)
    for c in taken:
        result = result.withColumn(f"resolved_{c}", F.when(found, F.col(f"_source.{c}")))
    return result.drop("_source", "_source_seq")


def dedup_savings(deduped: DataFrame, by: Sequence[str] = ("source",)) -> DataFrame:
    """Files, links and bytes that linking saved, per group."""
    linked = F.col("kind") == "link"
    return deduped.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(linked.cast("bigint")).alias("links"),
        F.sum(F.when(linked, F.col("orig_size")).otherwise(F.lit(0))).alias("bytes_saved"),
    )
