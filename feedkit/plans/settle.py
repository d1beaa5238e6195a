"""Cut a plan with a table written to the cluster's shared folder.

A written table survives lost executors, is computed once for all its readers, and carries file
sizes, so the planner broadcasts it only when its real size is under the broadcast limit.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder for `name` below the session's checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        # local-cluster has executors of its own, so it is a cluster here.
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="feedkit-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(folder)
    return folder


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write `df` once and go on from the written table."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop_settled(spark: SparkSession) -> int:
    """Remove what this process put into shared folders; call it when the readers are done."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    count = len(_written)
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
    return count
