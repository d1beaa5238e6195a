"""Generated feeds for load tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.operators.checksum import add_checksum
from feedkit.operators.custody import stamp_hop
from feedkit.operators.fragments import stable_uuid


def synth_feed(
    spark: SparkSession,
    n: int,
    min_size: int,
    max_size: int,
    name_format: str = "file%04d.dat",
    algo: str | None = "SHA1",
    seed: int = 0,
    ids: DataFrame | None = None,
    size: Column | None = None,
    rows_per_second: int = 10,
    host: str | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Files of zero bytes, sized uniformly in [min_size, max_size), or max_size where equal.

    `n` is the number of files; 0 makes an endless stream. `ids` (a table with a bigint `id`) and
    `size` give file numbers and sizes from data instead.
    """
    if min_size > max_size:
        raise ValueError("max_size is smaller than min_size")
    if ids is None and n > 0:
        ids = spark.range(n)
    elif ids is None:
        rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
        ids = rate.select(F.col("value").alias("id"))
    if size is None:
        span = max_size - min_size
        size = F.floor(F.rand(seed) * span) + min_size if span > 0 else F.lit(max_size)
    rows = ids.withColumn("size", size.cast("bigint")).select(
        F.col("id").alias("seq"),
        stable_uuid(F.lit("synth"), F.lit(seed), F.col("id")).alias("uuid"),
        F.lit("file").alias("kind"),
        F.lit("./").alias("path"),
        F.format_string(name_format, F.col("id")).alias("filename"),
        "size",
        F.repeat(F.char(F.lit(0)), F.col("size").cast("int")).cast("binary").alias("content"),
    )
    attrs = F.create_map(
        F.lit("path"), F.col("path"), F.lit("filename"), F.col("filename"), F.lit("uuid"), F.col("uuid")
    )
    rows = stamp_hop(rows.withColumn("attrs", attrs), "FLOOD", host=host, at=at)
    if algo is None:
        return rows
    blank = F.lit(None).cast("string")
    rows = rows.withColumns({"checksum_type": blank, "checksum": blank})
    return add_checksum(rows, algo, only_if_missing=True)
