"""Relay a feed through disk: one pass over the payload, split by outcome when it is read.

`forward_feed` gives three results that each read the feed. Here a call writes every row once, stamped and
with its own verdict, and a narrow table of the rejected batches; out, rejects and metrics are read from
these. A call's rows count once its marker is there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from feedkit.operators.checksum import RELAY, Policy, verify_checksum
from feedkit.operators.custody import append_forwarded_for, stamp_hop
from feedkit.operators.guards import with_route
from feedkit.plans.flows import with_gate
from feedkit.plans.skew import salted_lookup
from feedkit.sources.staging import _call_name, _marked, _write_marked


def relay_feed(
    files: DataFrame,
    folder: str,
    label: str,
    policy: Policy = RELAY,
    skip: bool = False,
    remote: str | Column | None = None,
    host: str | Column | None = None,
    request: Mapping[str, Column | str] | None = None,
    pass_metrics: bool = True,
    at: Column | None = None,
    key: Sequence[str] = ("seq",),
    call_id: str | None = None,
) -> dict[str, int]:
    """`forward_feed` into `folder`: rows, rejected gates, then the marker. Returns files, bytes and failed.

    Meter rows that travel on are there twice: as they came, and stamped. A call with a `call_id` whose
    marker is there changes nothing; one that broke off replaces what it had written.
    """
    spark = files.sparkSession
    if call_id is not None and _marked(spark, f"{folder}/relayed", call_id):
        return {"files": 0, "bytes": 0, "failed": 0}
    relay_id = _call_name(call_id)
    metered = F.col("route") == "metrics"
    both = F.array(F.lit("metered"), F.lit("carried")) if pass_metrics else F.array(F.lit("metered"))
    legs = F.when(metered, both).otherwise(F.array(F.lit("carried")))
    rows = with_route(files).withColumn("relay_leg", F.explode(legs)).drop("route")
    carried = F.col("relay_leg") == "carried"
    judged = verify_checksum(rows.withColumn("_row", F.struct(*rows.columns)), policy, skip)
    rows = judged.select("_row.*", F.when(carried, F.col("accepted")).otherwise(True).alias("stage_accepted"))
    # A meter row's own copy keeps what it came with.
    changed = ["attrs", *(["forwarded_for"] if remote is not None else [])]
    came = {f"_came_{c}": F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in changed}
    rows = rows.withColumns(came)
    stamped = stamp_hop(rows, label, host=host, request=request, at=at)
    if remote is not None:
        stamped = append_forwarded_for(stamped, remote)
    stamped = stamped.withColumns({c: F.when(carried, F.col(c)).otherwise(F.col(f"_came_{c}")) for c in changed})
    stamped = stamped.drop(*[f"_came_{c}" for c in changed]).withColumn("relay_id", F.lit(relay_id))
    stamped = with_gate(stamped, policy.scope, key).withColumnRenamed("_gate", "relay_gate")
    counts = _write_marked(stamped, f"{folder}/payload", ["relay_id", "relay_leg"])
    # Rejected gates are told from the verdicts on disk.
    if counts["files"] and counts["failed"]:
        own = spark.read.parquet(f"{folder}/payload/relay_id={relay_id}/relay_leg=carried")
        rejected = own.filter(~F.coalesce("stage_accepted", F.lit(False))).select("relay_gate").distinct()
        rejected.write.mode("overwrite").parquet(f"{folder}/rejected/relay_id={relay_id}")
    marker = [(relay_id, call_id, counts["files"], counts["bytes"], counts["failed"])]
    schema = "relay_id string, call_id string, files bigint, bytes bigint, failed bigint"
    spark.createDataFrame(marker, schema).coalesce(1).write.mode("append").parquet(f"{folder}/relayed")
    return counts


def relay_stream(stream: DataFrame, folder: str, checkpoint: str, name: str = "relay", **options) -> DataStreamWriter:
    """A writer that relays every micro-batch in one call, named by its number: one tried again changes nothing."""

    def relay(rows: DataFrame, number: int) -> None:
        relay_feed(rows, folder, call_id=f"{name}/{number}", **options)

    return stream.writeStream.foreachBatch(relay).option("checkpointLocation", checkpoint)


def read_relayed(
    spark: SparkSession, folder: str, spread_on: Sequence[str] = ("seq",)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(out, rejects, metrics) of all calls that are complete."""
    markers = spark.read.parquet(f"{folder}/relayed")
    rows = spark.read.parquet(f"{folder}/payload")
    # A row for each call; its size is on disk, so the planner knows whether to broadcast it.
    rows = rows.join(markers.select("relay_id").distinct(), "relay_id", "left_semi")
    extra = ["relay_id", "relay_leg", "relay_gate", "stage_accepted"]
    carried, metered = rows.filter("relay_leg = 'carried'"), rows.filter("relay_leg = 'metered'").drop(*extra)
    if markers.filter("failed > 0").isEmpty():
        return carried.drop(*extra), carried.filter(F.lit(False)).drop(*extra), metered
    gates = spark.read.parquet(f"{folder}/rejected")
    keys = ["relay_id", "relay_gate"]
    out = salted_lookup(carried, gates, keys, spread_on, "left_anti")
    rejects = salted_lookup(carried, gates, keys, spread_on, "left_semi")
    return out.drop(*extra), rejects.drop(*extra), metered
