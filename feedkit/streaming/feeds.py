"""Streaming operators: each takes and returns a streaming DataFrame.

`arrived_at` is the event time and `ttl` says how long, in event time, an unfinished key is kept. Rows
may come late by the whole `ttl`: unless `delay_ms` says otherwise, the watermark follows the newest row
at that distance, and nothing that is not yet expired is dropped. Only the columns that the state needs are sent to it, so payload stays behind; join the results to the
stored rows, or reassemble in `foreachBatch`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedkit.functions.paths import join
from feedkit.operators.dedup import CONTENT_KEY, as_links
from feedkit.operators.frames import with_slots
from feedkit.operators.metrics import feed_metrics
from feedkit.streaming.processors import (
    FirstSeenTracker,
    FragmentTracker,
    FrameTracker,
    SequenceTracker,
)

DAY_MS = 24 * 3600 * 1000


def _tracked(rows: DataFrame, keys: Sequence[str], kind, ttl_ms: int, delay_ms: int | None) -> DataFrame:
    delay = ttl_ms if delay_ms is None else delay_ms
    # The watermark already lags by the delay; what is left of the ttl is the timer's.
    processor = kind(max(ttl_ms - delay, 0))
    return (
        rows.withWatermark("arrived_at", f"{delay} milliseconds")
        .groupBy(*keys)
        .transformWithState(
            statefulProcessor=processor,
            outputStructType=processor.OUTPUT,
            outputMode="Append",
            timeMode="EventTime",
        )
    )


def _placed(rows: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that the state can work with, the others): a null in one of these columns ends nothing."""
    whole = F.lit(True)
    for name in needed:
        whole = whole & F.col(name).isNotNull()
    return rows.filter(whole), rows.filter(~whole)


def _with_rejects(tracked: DataFrame, rejects: DataFrame, **values: str) -> DataFrame:
    """Rows that the state could not work with, as events of their own, so that they can be counted."""
    kinds = {f.name: f.dataType for f in tracked.schema}
    given = {"event": F.lit("rejected"), **{k: F.col(v) for k, v in values.items()}}
    columns = [given.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in tracked.columns]
    return tracked.unionByName(rejects.select(*columns))


def stream_fragments(fragments: DataFrame, ttl_ms: int = DAY_MS, delay_ms: int | None = None) -> DataFrame:
    """Completed and expired files by output path, and rejected rows: those without a time, number or count."""
    narrow = fragments.select("path", "filename", "identifier", "idx", "cnt", "arrival", "arrived_at")
    good, bad = _placed(narrow, ["idx", "cnt", "arrival", "arrived_at"])
    tracked = _tracked(good, ["path", "filename"], FragmentTracker, ttl_ms, delay_ms)
    return _with_rejects(tracked, bad, path="path", filename="filename", identifier="identifier", cnt="cnt")


def stream_frames(
    frames: DataFrame, ttl_ms: int = DAY_MS, key: str = "port", delay_ms: int | None = None
) -> DataFrame:
    """Completed, abandoned and expired files, and rejected frames: those without a time, or whose header
    carries nothing (`with_slots`).

    Keyed by `port`, one file is in flight per port and the next one abandons it. Keyed by `uuid`,
    the work spreads over all files and only the time-out ends an unfinished one; choose it where a
    port carries a large part of the feed.
    """
    narrow = with_slots(frames).select(
        "port", "uuid", "total", "slot", "carries", "arrival", "arrived_at"
    )
    good, bad = _placed(narrow, ["total", "arrival", "arrived_at"])
    tracked = _tracked(good, [key], FrameTracker, ttl_ms, delay_ms)
    return _with_rejects(tracked, bad, port="port", uuid="uuid")


def stream_sequence(packets: DataFrame, ttl_ms: int = DAY_MS, delay_ms: int | None = None) -> DataFrame:
    """Released packets (`used` is the arrival of the copy that counts), expired sessions, and rejected
    packets: those without a session, a number from 1 up, or a time."""
    narrow = packets.select(
        "socket_id", "n", "op", "arrival", F.col("arrival").cast("string").alias("used"), "arrived_at"
    )
    named = F.nullif("socket_id", F.lit(""))
    counted = narrow.withColumns({"_named": named, "_n": F.when(F.col("n") >= 1, F.col("n"))})
    good, bad = _placed(counted, ["_named", "_n", "arrival", "arrived_at"])
    tracked = _tracked(good.drop("_named", "_n"), ["socket_id"], SequenceTracker, ttl_ms, delay_ms)
    return _with_rejects(tracked, bad, socket_id="socket_id", n="n", used="used")


def stream_dedup(files: DataFrame, ttl_ms: int = DAY_MS, delay_ms: int | None = None) -> DataFrame:
    """Files in the order of seq; repeated content comes out as links: seq, filepath, kind, target."""
    named = files.withColumn("filepath", join(F.col("path"), F.col("filename")))
    # A file without a time or a number cannot be put in order: it stays a file.
    has_key = (F.col("size") > 0) & F.col("checksum").isNotNull() & F.col("seq").isNotNull() & F.col("arrived_at").isNotNull()
    cols = ["seq", "filepath", "size", *[c for c in CONTENT_KEY if c != "size"], "arrived_at"]
    keyed = _tracked(named.filter(has_key).select(*cols), CONTENT_KEY, FirstSeenTracker, ttl_ms, delay_ms)
    plain = named.filter(~F.coalesce(has_key, F.lit(False))).select(
        "seq", "filepath", F.lit(None).cast("string").alias("first_path")
    )
    rows = keyed.unionByName(plain).withColumns({"kind": F.lit("file"), "size": F.lit(0)})
    linked = as_links(rows, F.col("first_path").isNotNull(), F.col("first_path"))
    return linked.select("seq", "filepath", "kind", "target")


def stream_metrics(
    metrics: DataFrame, every: str = "5 minutes", delay: str = "1 minute"
) -> DataFrame:
    """The periodic report; a period comes out once the watermark has passed it."""
    return feed_metrics(metrics.withWatermark("ts", delay), every)


def run_available(stream: DataFrame, folder: str) -> StreamingQuery:
    """Process what has arrived, append it to `folder`/out, and remember it in `folder`/state."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
