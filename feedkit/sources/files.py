"""Files on disk and the static attribute file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedkit.functions.attributes import attr_lines
from feedkit.functions.paths import dirname
from feedkit.operators.guards import walk_order
from feedkit.plans.settle import settle
from feedkit.sources.ranges import scan_ranges


def scan_files(
    spark: SparkSession, paths: Sequence[str], manifest: DataFrame | None = None, range_bytes: int | None = None
) -> DataFrame:
    """One row per file below the given paths: arg_pos, filepath, path, filename, kind,
    modified_at, size, content.

    Columns that are not used, `content` above all, are not read. Spark's file source lists neither
    empty files nor directories; pass them as `manifest` (arg_pos, filepath, kind, modified_at) to
    have them in the feed. Use `number_in_walk_order` for the order of a walk.

    With `range_bytes`, files of any size come out in ranges of so many bytes, empty files and directories
    among them: the rows of `scan_ranges`.
    """
    if range_bytes is not None:
        if manifest is not None:
            raise ValueError("ranges list empty files and directories by themselves")
        return scan_ranges(spark, paths, range_bytes)

    def one(pos: int, path: str) -> DataFrame:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return listed.select(
            F.lit(pos).alias("arg_pos"),
            F.regexp_replace("path", "^file:/*", "/").alias("filepath"),
            F.lit("file").alias("kind"),
            F.col("modificationTime").alias("modified_at"),
            F.col("length").alias("size"),
            "content",
        )

    rows = reduce(DataFrame.unionByName, [one(i, p) for i, p in enumerate(paths)])
    if manifest is not None:
        empty = manifest.select("arg_pos", "filepath", "kind", "modified_at").withColumns(
            {"size": F.lit(0).cast("bigint"), "content": F.lit(None).cast("binary")}
        )
        rows = rows.unionByName(empty)
    return rows.withColumns(
        {
            "path": dirname(F.col("filepath")),
            "filename": F.regexp_extract("filepath", r"([^/]*)$", 1),
        }
    )


def number_in_walk_order(
    files: DataFrame, arg_pos: str = "arg_pos", path: str = "filepath"
) -> DataFrame:
    """Add `seq`, 0 for the first file of the walk, without sorting in one task.

    The sort is a range partitioning; a row's number is its place in its partition plus the sizes of
    the partitions before it. The sorted rows are written once, without payload, so both parts see the
    same ranges.
    """
    placed = walk_order(files.drop("content"), arg_pos, path).withColumn("_id", F.monotonically_increasing_id())
    done = settle(placed, "walk").withColumns(
        {"_part": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = done.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition: the window and the broadcast are as small as the partition count.
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    numbered = done.join(F.broadcast(starts), "_part")
    return numbered.withColumn("seq", F.col("_start") + F.col("_place")).drop(
        "_id", "_part", "_place", "_start"
    )


def read_static_attrs(spark: SparkSession, file: str) -> DataFrame:
    """(pos, name, value) from a file of `name: value` lines; pos is the line number."""
    return parse_static_attrs(spark.read.text(file, wholetext=True).withColumnRenamed("value", "text"))


def parse_static_attrs(texts: DataFrame, text: str = "text", keys: Sequence[str] = ()) -> DataFrame:
    """The same for a column of whole texts, each parsed once."""
    lines = texts.select(*keys, F.inline_outer(attr_lines(F.col(text))))
    return lines.filter(F.col("pos").isNotNull())
