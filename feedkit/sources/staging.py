"""Stage a feed on disk, see which batches are committed, and replay them."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from feedkit.functions.attributes import literal_attrs, set_attrs
from feedkit.operators.checksum import STAGE, verify_checksum
from feedkit.operators.custody import stamp_hop
from feedkit.operators.guards import path_guard
from feedkit.plans.settle import settle
from feedkit.plans.skew import join_null_safe, salted_lookup

POLL = "3 seconds"


def staged(files: DataFrame, host: str | None = None, at: Column | None = None) -> DataFrame:
    """The rows as they are stored: hop stamped and size kept as an attribute."""
    stamped = stamp_hop(files, "TO-DISK", host=host, at=at)
    size = literal_attrs({"size": F.col("size")})
    return stamped.withColumn("attrs", set_attrs(F.col("attrs"), size))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _remove(spark: SparkSession, path: str, archive: str | None = None) -> None:
    """Delete a folder, or move it to `archive`, a path of the same file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if archive is None:
        store.delete(at, True)
    elif store.exists(at):
        to = spark._jvm.org.apache.hadoop.fs.Path(archive)
        store.mkdirs(to.getParent())
        store.rename(at, to)


def _marked(spark: SparkSession, folder: str, call_id: str) -> bool:
    """True if a call of this name has left its markers."""
    if not _exists(spark, folder):
        return False
    markers = spark.read.option("mergeSchema", "true").parquet(folder)
    return not markers.filter(F.col("call_id") == call_id).isEmpty()


def _call_name(call_id: str | None) -> str:
    """A folder name for one call: the same one if a named call is repeated. The letter keeps it a text."""
    return "s" + (hashlib.sha256(call_id.encode()).hexdigest()[:32] if call_id is not None else uuid.uuid4().hex)


def _write_marked(rows: DataFrame, payload: str, parts: Sequence[str]) -> dict[str, int]:
    """The one pass over the payload: write it below its call's own folder, and count it on the way.

    A call that is repeated replaces what it had written.
    """
    counts = Observation()
    bad = (~F.coalesce("stage_accepted", F.lit(False))).cast("bigint")
    watched = rows.observe(
        counts,
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(bad), F.lit(0)).alias("failed"),
    )
    writer = watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(payload)
    return dict(counts.get)


def stage_feed(
    files: DataFrame,
    folder: str,
    host: str | None = None,
    at: Column | None = None,
    verify: bool = True,
    keep_partial: bool = False,
    batch_parts: int | None = None,
    call_id: str | None = None,
) -> dict[str, int]:
    """Store a feed for replay below `folder`: `payload`, then `markers`. Returns files, bytes and failed.

    The feed is read once: its rows are hashed, judged and written in one pass, and what a batch is worth is
    told from the verdicts on disk. A batch that holds an unverified file gets no marker; of files without a
    batch each stands for itself. The markers appear after the payload is committed and name this call
    (`stage_id`), so payload of a call that broke off is never read. Payload lies in a folder for each
    batch or, with many small batches, in `batch_parts` hash buckets. Folders without a marker are removed
    unless `keep_partial`; in buckets, rows of rejected batches stay and are never read.
    A call with a `call_id` whose markers are there changes nothing, and one that broke off replaces what
    it had written, so a micro-batch that is tried again stages its files once.
    """
    spark = files.sparkSession
    markers = f"{folder}/markers"
    if call_id is not None and _marked(spark, markers, call_id):
        return {"files": 0, "bytes": 0, "failed": 0}
    stage_id = _call_name(call_id)
    if verify:
        judged = verify_checksum(files.withColumn("_row", F.struct(*files.columns)), STAGE)
        # The feed's own columns stay as they are, whatever their names.
        rows = judged.select("_row.*", F.col("accepted").alias("stage_accepted"))
    else:
        rows = files.withColumn("stage_accepted", F.lit(True))
    if batch_parts:
        bucket = F.pmod(F.xxhash64("batch_id"), F.lit(batch_parts).cast("bigint"))
        part = F.concat(F.lit("h"), bucket.cast("string"))
    else:
        part = F.coalesce(F.concat(F.lit("b"), F.col("batch_id").cast("string")), F.lit("none"))
    rows = staged(rows, host, at).withColumns({"stage_id": F.lit(stage_id), "batch_part": part})
    counts = _write_marked(rows, f"{folder}/payload", ["stage_id", "batch_part"])
    own = f"{folder}/payload/stage_id={stage_id}"
    if not counts["files"]:
        return counts
    told = spark.read.parquet(own).groupBy("batch_id", "batch_part")
    good = F.col("stage_accepted")
    told = told.agg(F.count_if(good).alias("files"), F.count_if(~F.coalesce(good, F.lit(False))).alias("_bad"))
    passed = told.filter((F.col("files") > 0) & ((F.col("_bad") == 0) | F.col("batch_id").isNull()))
    passed = settle(passed.drop("_bad"), "passed") if counts["failed"] else passed.drop("_bad")
    if counts["failed"] and not keep_partial and not batch_parts:
        # A name for each rejected batch, as each has a folder to remove.
        named = passed.select("batch_part").distinct()
        for row in told.select("batch_part").distinct().join(named, "batch_part", "left_anti").toLocalIterator():
            _remove(spark, f"{own}/batch_part={_escaped(spark, row['batch_part'])}")
    passed = passed.withColumns({"stage_id": F.lit(stage_id), "call_id": F.lit(call_id).cast("string")})
    passed.write.mode("append").parquet(markers)
    return counts


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as folder names spell it."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def stage_stream(stream: DataFrame, folder: str, checkpoint: str, name: str = "stage", **options) -> DataStreamWriter:
    """A writer that stages every micro-batch in one call, named by its number.

    A micro-batch that is tried again changes nothing. `options` are those of `stage_feed`; batches must
    arrive whole, for each micro-batch is judged by itself.
    """

    def stage(rows: DataFrame, number: int) -> None:
        stage_feed(rows, folder, call_id=f"{name}/{number}", **options)

    return stream.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint)


def committed_batches(
    payloads: DataFrame,
    markers: DataFrame,
    spread_on: Sequence[str] = ("seq",),
    keys: Sequence[str] = ("batch_id",),
) -> DataFrame:
    """Payload rows whose batch has a commit marker; one batch may hold most of the rows."""
    named = settle(markers.select(*keys).distinct(), "named")  # files without a batch form one, named null
    return salted_lookup(payloads, named, keys, spread_on, "left_semi")


def _readable(payloads: DataFrame) -> DataFrame:
    """Files without a batch stand for themselves, so a marker of theirs does not speak for all."""
    return payloads.filter(F.col("batch_id").isNotNull() | F.col("stage_accepted"))


def read_staged(spark: SparkSession, folder: str, spread_on: Sequence[str] = ("seq",)) -> DataFrame:
    """The committed part of a staged feed, as a table."""
    payloads = _readable(spark.read.parquet(f"{folder}/payload"))
    markers = spark.read.parquet(f"{folder}/markers")
    return committed_batches(payloads, markers, spread_on, ("batch_id", "stage_id"))


#: Up to so many payload folders of a micro-batch are named to the reader; with more, their calls' are.
NAMED_FOLDERS = 1000


def _payload_of(spark: SparkSession, folder: str, markers: DataFrame, spread_on: Sequence[str]) -> DataFrame | None:
    """The payload that some markers name; nothing else is listed or read."""
    payload = f"{folder}/payload"
    parts = markers.select("stage_id", "batch_part").distinct().limit(NAMED_FOLDERS + 1).collect()
    if len(parts) <= NAMED_FOLDERS:
        paths = [f"{payload}/stage_id={p['stage_id']}/batch_part={_escaped(spark, p['batch_part'])}" for p in parts]
    else:
        # A row for each staging call.
        paths = [f"{payload}/stage_id={p['stage_id']}" for p in markers.select("stage_id").distinct().collect()]
    # What a repeated micro-batch had delivered may have been cleaned away since.
    paths = [p for p in paths if _exists(spark, p)]
    if not paths:
        return None
    rows = _readable(spark.read.option("basePath", payload).parquet(*paths))
    return committed_batches(rows, markers, spread_on, ("batch_id", "stage_id"))


def replay_feed(
    spark: SparkSession,
    folder: str,
    deliver: Callable[[DataFrame, int], None],
    checkpoint: str,
    clean: str = "off",
    archive: str | None = None,
    max_files_per_trigger: int | None = None,
    host: str | None = None,
    at: Column | None = None,
    spread_on: Sequence[str] = ("seq",),
) -> DataStreamWriter:
    """A writer that hands the committed part of a staged feed to `deliver(rows, number)`, as it is staged.

    The stream is the table of markers: each micro-batch reads the payload folders that its markers name,
    so payload of a call that broke off or of a rejected batch is never looked at. Rows have the replay
    hop stamped; unsafe paths do not come out. A micro-batch whose delivery failed comes again with the
    same number. `clean` is `delete`, `archive` (into `archive`) or `off`: folders all of whose batches
    have been delivered go once they were. `replay_into` is the form that writes a table.
    """
    if clean not in ("off", "delete", "archive") or (clean == "archive") != (archive is not None):
        raise ValueError("clean is off, delete, or archive with a folder")
    schema = spark.read.parquet(f"{folder}/markers").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def handle(rows: DataFrame, number: int) -> None:
        # Written, so that the planner knows how few they are.
        markers = settle(rows.distinct(), "markers")
        payload = _payload_of(spark, folder, markers, spread_on)
        if payload is not None:
            safe, _ = path_guard(payload, strict_filename=False)
            deliver(stamp_hop(safe.drop("clean_path", "path_ok"), "FROM-DISK", host=host, at=at), number)
        markers.write.mode("overwrite").parquet(f"{checkpoint}/delivered/number={number}")
        if clean != "off":
            drop_replayed(spark, folder, checkpoint, markers, archive)

    stream = reader.parquet(f"{folder}/markers")
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{checkpoint}/state")


def drop_replayed(
    spark: SparkSession, folder: str, checkpoint: str, markers: DataFrame, archive: str | None = None
) -> int:
    """Remove the payload folders of `markers` all of whose batches have been delivered; how many."""
    calls = markers.select("stage_id").distinct()
    place = ["stage_id", "batch_part"]
    done = spark.read.parquet(f"{checkpoint}/delivered").select(*place, "batch_id").distinct()
    todo = spark.read.parquet(f"{folder}/markers").join(F.broadcast(calls), "stage_id")
    left = join_null_safe(todo.select(*place, "batch_id").distinct(), done, [*place, "batch_id"], "left_anti")
    whole = markers.select(*place).distinct().join(left.select(*place).distinct(), place, "left_anti")
    count = 0
    for row in whole.toLocalIterator():
        name = f"stage_id={row['stage_id']}/batch_part={_escaped(spark, row['batch_part'])}"
        _remove(spark, f"{folder}/payload/{name}", archive and f"{archive}/{name}")
        count += 1
    return count


def replay_into(spark: SparkSession, folder: str, out: str, checkpoint: str, **options) -> DataStreamWriter:
    """`replay_feed` into a table of files below `out`, each micro-batch in a folder of its own.

    A micro-batch that comes again replaces its folder, so every file is there once.
    """

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/number={number}")

    return replay_feed(spark, folder, write, checkpoint, **options)


def on_complete(
    stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False
) -> DataStreamWriter:
    """A writer that hands every finished micro-batch to `fn(rows, batch_number)`."""
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=POLL)
