"""Datagram frames: parse headers, tell runs apart, report status, put files back together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.operators.checksum import FROM_FRAMES, Policy, verify_checksum
from feedkit.operators.fragments import MAX_CELL, join_pieces
from feedkit.plans.folding import arrived_first, file_digests
from feedkit.plans.ordered import runs
from feedkit.plans.settle import settle
from feedkit.plans.skew import join_null_safe

# The frame header is UUID 16 bytes, size 8, offset 8, MTU 2, all big-endian.
HEADER_BYTES = 34
MIN_MTU = 100


def _unsigned(data: Column, start: int, length: int) -> Column:
    """Big-endian unsigned number as bigint, null above its range."""
    return F.conv(F.hex(F.substring(data, start, length)), 16, 10).try_cast("bigint")


def parse_frames(datagrams: DataFrame, data: str = "data") -> DataFrame:
    """Header fields and payload of each datagram.

    Datagrams shorter than the header, with an MTU under 100 or with a number above the bigint range
    drop out. A frame of just the header has no payload.
    """
    raw = F.col(data)
    usable = datagrams.filter(F.octet_length(raw) >= HEADER_BYTES)
    h = F.lower(F.hex(F.substring(raw, 1, 16)))
    uid = F.concat_ws(
        "-", *[F.substring(h, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    )
    body = F.substring(raw, F.lit(HEADER_BYTES + 1), F.octet_length(raw))
    return (
        usable.withColumns(
            {
                "uuid": uid,
                "size": _unsigned(raw, 17, 8),
                "offset": _unsigned(raw, 25, 8),
                "mtu": _unsigned(raw, 33, 2).cast("int"),
                "payload": F.when(F.octet_length(raw) > HEADER_BYTES, body),
                "length": F.octet_length(raw) - HEADER_BYTES,
            }
        )
        .filter((F.col("mtu") >= MIN_MTU) & F.col("size").isNotNull() & F.col("offset").isNotNull())
        .drop(data)
    )


def frame_faults(datagrams: DataFrame, data: str = "data") -> DataFrame:
    """(fault, frames): how many datagrams `parse_frames` leaves out, and why: `short`, `mtu` or `range`."""
    raw = F.col(data)
    mtu = _unsigned(raw, 33, 2)
    beyond = _unsigned(raw, 17, 8).isNull() | _unsigned(raw, 25, 8).isNull()
    fault = (
        F.when(F.coalesce(F.octet_length(raw), F.lit(0)) < HEADER_BYTES, "short")
        .when(mtu < MIN_MTU, "mtu")
        .when(beyond, "range")
    )
    told = datagrams.select(fault.alias("fault")).filter("fault IS NOT NULL")
    return told.groupBy("fault").agg(F.count(F.lit(1)).alias("frames"))


def frame_header(uuid: Column, size: Column, offset: Column, mtu: Column) -> Column:
    """The binary header of a frame, the inverse of `parse_frames`."""

    def number(value: Column, digits: int) -> Column:
        return F.lpad(F.hex(value.cast("bigint")), digits, "0")

    text = F.concat(
        F.replace(uuid, F.lit("-"), F.lit("")), number(size, 16), number(offset, 16), number(mtu, 4)
    )
    return F.unhex(text)


def with_slots(frames: DataFrame) -> DataFrame:
    """Add `total`, the number of slots of the file, `slot`, the one this frame fills, and `carries`.

    A frame carries data if it has a payload and its slot exists. With a `length` column (as from
    `parse_frames`) the payload itself is not looked at. A frame with an MTU under 100, or without a size
    or an offset, carries nothing and has neither total nor slot, as `parse_frames` would have dropped it.
    """
    if "length" in frames.columns:
        data = F.col("length") > 0
    elif "payload" in frames.columns:
        data = F.col("payload").isNotNull()
    else:
        data = F.lit(True)
    usable = f"mtu >= {MIN_MTU} AND size >= 0 AND offset >= 0"
    placed = frames.withColumns(
        {
            "total": F.expr(f"CASE WHEN {usable} THEN CASE WHEN size > 0 THEN (size - 1) div mtu + 1 ELSE 1 END END"),
            # (offset + 1) div mtu, also for the largest offset.
            "slot": F.expr(f"CASE WHEN {usable} THEN offset div mtu + (offset % mtu + 1) div mtu END"),
        }
    )
    return placed.withColumn("carries", F.coalesce(data & (F.col("slot") < F.col("total")), F.lit(False)))


def inflight_runs(
    frames: DataFrame, port: str = "port", order: str = "arrival", parts: int | None = None
) -> DataFrame:
    """One file is in flight per port: a frame of another file starts a new run.

    Adds `run_start` (the run's first arrival) and `followed`, true where the port went on to
    another file. The runs are told from the keys and come back by (port, order, uuid); frames that
    share all three are in one run.
    """
    told = runs(frames.select(port, order, "uuid"), [port], order, "uuid", parts)
    told = told.groupBy(port, order, "uuid").agg(
        F.min("run_start").alias("run_start"),
        (F.min("run_start") < F.min("last_run_start")).alias("followed"),
    )
    return join_null_safe(frames, told, [port, order, "uuid"])


def frame_status(
    frames: DataFrame, by: Sequence[str] = ("uuid",), order: str = "arrival"
) -> DataFrame:
    """Slots seen per file and how many frames were repeats.

    The first frame to arrive says how many slots the file has; a frame whose slot lies beyond its
    own header's count is ignored. Repeats are counted away inside the map tasks.
    """
    placed = frames if "carries" in frames.columns else with_slots(frames)
    placed = placed.filter("total IS NOT NULL")
    slots = (
        placed.withColumn("slot", F.when(F.col("carries"), F.col("slot")))
        .groupBy(*by, "slot")
        .agg(
            F.count(F.lit(1)).alias("_copies"),
            F.min(arrived_first(order)).alias("_first"),
            F.min_by("total", arrived_first(order)).alias("_total"),
        )
    )
    return (
        slots.groupBy(*by)
        .agg(
            F.min_by("_total", "_first").alias("total"),
            F.count("slot").alias("seen"),
            F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("_copies"))), F.lit(0)).alias("_frames"),
        )
        .select(
            *by,
            "total",
            "seen",
            (F.col("_frames") - F.col("seen")).alias("dups"),
            F.when(F.col("seen") == F.col("total"), "complete").otherwise("incomplete").alias("state"),
        )
    )


def judged_runs(placed: DataFrame, port: str = "port", order: str = "arrival") -> DataFrame:
    """Status of every run of marked frames (`inflight_runs` and `with_slots`); `followed` stays."""
    status = frame_status(placed, [port, "uuid", "run_start", "followed"], order)
    abandoned = (F.col("state") == "incomplete") & F.col("followed")
    return status.withColumn("state", F.when(abandoned, "abandoned").otherwise(F.col("state")))


def run_status(
    frames: DataFrame, port: str = "port", order: str = "arrival", parts: int | None = None
) -> DataFrame:
    """Status of every run: `complete`, `abandoned` (another file took its port) or `incomplete`."""
    narrow = with_slots(frames).select(port, order, "uuid", "total", "slot", "carries").filter("total IS NOT NULL")
    told = runs(narrow, [port], order, "uuid", parts)
    told = told.withColumn("followed", F.col("run_start") < F.col("last_run_start"))
    return judged_runs(told, port, order).drop("followed")


def reassemble_frames(
    frames: DataFrame,
    checksums: DataFrame | None = None,
    by: Sequence[str] = ("uuid",),
    order: str = "arrival",
    policy: Policy = FROM_FRAMES,
    max_cell: int = MAX_CELL,
) -> DataFrame:
    """Complete files from their frames.

    The first copy of each slot counts. `checksums` (uuid, checksum_type, checksum) brings the
    expected values, which `policy` then judges. Adds `assembly`: `complete` or `corrupt` (a piece does
    not fit its slot, or the bytes do not add up to the announced size); incomplete files are left out. A
    file of more than `max_cell` bytes gets the same verdicts from a running digest over its pieces, and
    its `content` is null.
    """
    first = arrived_first(order)
    placed = with_slots(frames).filter("carries")
    # A piece is sound if it starts where its slot does and is as long as its slot.
    starts = F.col("offset") == F.col("slot") * F.col("mtu")
    fills = F.octet_length("payload") == F.least(F.col("mtu"), F.col("size") - F.col("offset"))
    placed = placed.withColumn("_sound", F.coalesce(starts & fills, F.lit(False)))
    lengths = placed.groupBy(*by, "slot").agg(F.min_by(F.octet_length("payload"), first).alias("_bytes"))
    large = lengths.groupBy(*by).agg(F.sum("_bytes").alias("_bytes")).filter(F.col("_bytes") > max_cell)
    large = settle(large.select(*by, F.lit(True).alias("_large")), "large")
    pieces = placed.groupBy(*by, "slot").agg(
        F.min_by(F.struct("payload", "size", "total", "_sound"), first).alias("_own"), F.min(first).alias("_first")
    )
    pieces = join_null_safe(pieces, large, by, "left").select(*by, "slot", "_first", "_own.*", "_large")
    pieces = pieces.withColumns(
        {"_length": F.octet_length("payload").cast("bigint"), "payload": F.when(F.col("_large").isNull(), F.col("payload"))}
    )
    carried = [
        F.min_by("size", "_first").alias("size"),
        F.min_by("total", "_first").alias("total"),
        F.max("_large").alias("_large"),
        F.sum("_length").alias("_length"),
        F.bool_and("_sound").alias("_all_sound"),
    ]
    whole = join_pieces(pieces, by, "slot", "payload", carried).filter("seen = total")
    exact = (F.col("_length") == F.col("size")) & F.col("_all_sound")
    files = whole.withColumns(
        {
            "assembly": F.when(exact, "complete").otherwise("corrupt"),
            "content": F.when(F.col("_large").isNull(), F.col("content")),
        }
    ).drop("_all_sound", "_length", "seen", "total")
    if checksums is None:
        return files.drop("_large")
    expected = checksums.select("uuid", "checksum_type", "checksum")
    named = files.join(expected, "uuid", "left")
    if large.isEmpty():
        judged = verify_checksum(named, policy)
    else:
        parts = placed.select(*{*by, "uuid"}, "slot", "payload", first.alias("_first"))
        parts = join_null_safe(parts, large.select(*by), by).join(expected.select("uuid", "checksum_type"), "uuid", "left")
        digests = settle(file_digests(parts, by, "slot", "payload", "checksum_type", F.col("_first")), "digests")
        named = join_null_safe(named, digests.select(*by, F.col("digest").alias("_digest")), by, "left")
        judged = verify_checksum(named, policy, actual=F.when(F.col("_large"), F.col("_digest"))).drop("_digest")
    return judged.withColumn("accepted", F.col("accepted") & (F.col("assembly") == "complete")).drop("_large")
