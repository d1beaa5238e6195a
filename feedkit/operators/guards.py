"""Path safety, link safety and routing by kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.functions.paths import clean, escapes, walk_key

ROUTES = ("file", "dir", "link", "metrics", "reject")


def mark_paths(files: DataFrame, strict_filename: bool = True) -> DataFrame:
    """Add `clean_path` and `path_ok`.

    `strict_filename` also refuses file names that are more than one path element; turn it off to
    check the directory alone.
    """
    marked = files.withColumn("clean_path", clean(F.coalesce(F.col("path"), F.lit(""))))
    ok = ~escapes(F.col("clean_path"))
    if strict_filename:
        name = F.coalesce(F.col("filename"), F.lit(""))
        ok = ok & ~name.contains("/") & (name != "..")
    return marked.withColumn("path_ok", ok)


def path_guard(files: DataFrame, strict_filename: bool = True) -> tuple[DataFrame, DataFrame]:
    """(ok, rejects) by the cleaned directory."""
    marked = mark_paths(files, strict_filename)
    return marked.filter("path_ok"), marked.filter("NOT path_ok")


def mark_links(links: DataFrame) -> DataFrame:
    """Add `resolved`, the path a link points to, and `link_ok`."""
    target = F.coalesce(F.col("target"), F.lit(""))
    pointed = F.concat_ws("/", F.nullif(F.col("path"), F.lit("")), F.nullif(target, F.lit("")))
    marked = links.withColumn("resolved", clean(pointed))
    usable = (target != "") & ~target.startswith("/") & ~escapes(F.col("resolved"))
    return marked.withColumn("link_ok", usable)


def link_guard(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok, dropped): links that stay inside the feed, and the others."""
    marked = mark_links(links)
    return marked.filter("link_ok"), marked.filter("NOT link_ok")


def with_route(files: DataFrame) -> DataFrame:
    """Add `route`; no kind means file, an unknown kind is a reject."""
    kind = F.coalesce(F.col("kind"), F.lit(""))
    return files.withColumn(
        "route",
        F.when(kind.isin("", "file"), "file")
        .when(kind.isin("dir", "link", "metrics"), kind)
        .otherwise("reject"),
    )


def route_by_kind(files: DataFrame) -> dict[str, DataFrame]:
    """One DataFrame per route; to write all at once, write `with_route` partitioned by route."""
    routed = with_route(files)
    return {route: routed.filter(F.col("route") == route) for route in ROUTES}


def walk_order(files: DataFrame, arg_pos: str = "arg_pos", path: str = "filepath") -> DataFrame:
    """Argument order, then each directory in lexical order of its entries."""
    return files.orderBy(F.col(arg_pos), walk_key(F.col(path)))
