"""Session settings the operators rely on."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BATCH_BYTES = 64 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings: UTC clock, a state store that supports timers, Arrow batches bounded by bytes."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    # Pieces of files may be large: a batch for Python ends by bytes as well as by rows.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    on_one_machine = re.match(r"local(\[|$)", spark.sparkContext.master) is not None
    if on_one_machine and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return spark


def local_session(cores: int | str = "*", app: str = "feedkit", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    parallel = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", parallel)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        # Small tables still use all cores: their rows are few but cost a lot of computing.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())
