"""Cut large files into fragments and put fragments back together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.attributes import literal_attrs, set_attrs
from feedkit.functions.hashing import digest, digest_by
from feedkit.plans.folding import arrived_first, file_digests, file_key, fold_files
from feedkit.plans.ordered import number_gaps, runs
from feedkit.plans.settle import settle
from feedkit.plans.skew import LOOKUP_SALTS, join_null_safe, salted, salted_lookup

# A cell must stay well under 2 GiB; larger files keep their payload in ordered pieces.
MAX_CELL = 1 << 30
# Bytes of a piece, where a file is cut without a limit of the receiver.
RANGE_BYTES = 64 << 20
# Ranges of missing numbers are spelled out level by level, so that no array gets long.
RANGE_STEPS = (10**12, 10**8, 10**4, 1)


def smaller_limit(a: int, b: int) -> int:
    """The limit that holds when two are set: the smaller one, where 0 means none."""
    return min(a, b) if a > 0 and b > 0 else max(a, b)


def stable_uuid(*key: Column) -> Column:
    """A UUID-shaped name that is the same on every retry of a task."""
    return F.regexp_replace(
        F.md5(F.concat_ws("/", *[k.cast("string") for k in key])),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$",
        "$1-$2-$3-$4-$5",
    )


def segment(
    files: DataFrame, max_size: int, algo: str = "SHA256", key: Sequence[str] = ("seq",)
) -> DataFrame:
    """Cut files larger than `max_size` bytes into numbered fragments; 0 turns it off.

    Every row gets the fragment columns; on files that stay whole they are null. A fragment has its
    own uuid and checksum and keeps the name, size and checksum of its parent.
    """
    size = F.col("size")
    big = (size > max_size) if max_size > 0 else F.lit(False)
    step = F.lit(max(max_size, 1)).cast("bigint")
    count = F.when(big, F.expr(f"(size + {max(max_size, 1) - 1}) div {max(max_size, 1)}"))
    identifier = stable_uuid(F.lit("file"), *[F.col(k) for k in key])
    rows = files.withColumns({"_big": big, "fragment_count": count.cast("bigint")}).withColumn(
        "_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("fragment_count", F.lit(1)) - 1))
    )

    def on_parts(value: Column, otherwise: Column | None = None) -> Column:
        chosen = F.when(F.col("_big"), value)
        return chosen if otherwise is None else chosen.otherwise(otherwise)

    offset = F.col("_i") * step
    part = F.substring(F.col("content"), (offset + 1).cast("int"), F.lit(max(max_size, 1)))
    rows = rows.withColumns(
        {
            "fragment_identifier": on_parts(identifier),
            "fragment_index": on_parts(F.col("_i") + 1),
            "fragment_offset": on_parts(offset),
            "orig_filename": on_parts(F.col("filename")),
            "orig_size": on_parts(size),
            "orig_checksum_type": on_parts(F.col("checksum_type")),
            "orig_checksum": on_parts(F.col("checksum")),
            "content": on_parts(part, F.col("content")),
        }
    )
    rows = rows.withColumns(
        {
            # Of a row without content the lengths that its parts would have.
            "size": on_parts(F.least(step, F.col("orig_size") - F.col("fragment_offset")), size),
            "checksum_type": on_parts(F.lit(algo), F.col("checksum_type")),
            "checksum": on_parts(digest(F.col("content"), algo), F.col("checksum")),
        }
    )
    uid = stable_uuid(F.col("fragment_identifier"), F.col("fragment_index"))
    if "uuid" in files.columns:
        rows = rows.withColumn("uuid", on_parts(uid, F.col("uuid")))
    else:
        rows = rows.withColumn("uuid", on_parts(uid))
    if "attrs" in files.columns:
        named = literal_attrs(
            {
                "fragment.identifier": F.col("fragment_identifier"),
                "fragment.index": F.col("fragment_index"),
                "fragment.count": F.col("fragment_count"),
                "fragment.offset": F.col("fragment_offset"),
                "segment.original.size": F.col("orig_size"),
                "segment.original.filename": F.col("orig_filename"),
                "segment.original.checksumType": F.col("orig_checksum_type"),
                "segment.original.checksum": F.col("orig_checksum"),
                "uuid": F.col("uuid"),
                "checksumType": F.col("checksum_type"),
                "checksum": F.col("checksum"),
            }
        )
        rows = rows.withColumn("attrs", on_parts(set_attrs(F.col("attrs"), named), F.col("attrs")))
    return rows.drop("_big", "_i")


def _usable(idx: str = "idx", cnt: str = "cnt") -> Column:
    return (F.col(cnt) > 1) & F.col(idx).between(F.lit(1), F.col(cnt))


#: What a file's first row announces about it.
ANNOUNCED = ("cnt", "orig_size", "orig_checksum_type", "orig_checksum")


def first_row(order: str, announced: Sequence[str] = ANNOUNCED) -> Column:
    """Struct whose minimum over a file's rows is its first row, with what that one announces."""
    return F.struct(arrived_first(order).alias("first"), F.col("idx").alias("at"), *announced)


def _without_strays(slots: DataFrame, by: Sequence[str]) -> DataFrame:
    """Slots (by, idx, `_f`: the first row's struct) up to the count of each file's first row.

    Files whose rows name different counts are few; they are told in a narrow table of their own.
    """
    sums = slots.groupBy(*by).agg(F.min("_f").alias("_f"), F.min("_f.cnt").alias("_low"), F.max("_f.cnt").alias("_high"))
    unclear = settle(sums.filter("_low <> _high").select(*by, F.col("_f.cnt").alias("_cnt")), "counts")
    marked = join_null_safe(slots, unclear, by, "left")
    return marked.filter(F.col("_cnt").isNull() | (F.col("idx") <= F.col("_cnt"))).drop("_cnt")


def fragment_status(
    fragments: DataFrame, by: Sequence[str] = ("identifier",), order: str = "arrival"
) -> DataFrame:
    """Distinct pieces seen per file; complete when every index 1..cnt was seen.

    The first row to arrive says how many pieces the file has (without an `order` column: the smallest
    count); rows beyond that do not count.
    """
    valid = fragments.filter(_usable())
    if order in fragments.columns:
        slots = valid.groupBy(*by, "idx").agg(F.min(first_row(order, ["cnt"])).alias("_f"))
    else:
        slots = valid.groupBy(*by, "idx").agg(F.min(F.struct("cnt")).alias("_f"))
    return (
        _without_strays(slots, by)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("seen"), F.min("_f").alias("_f"))
        .select(*by, "seen", F.col("_f.cnt").alias("cnt"))
        .withColumn("state", F.when(F.col("seen") == F.col("cnt"), "complete").otherwise("incomplete"))
    )


def missing_ranges(
    fragments: DataFrame, by: Sequence[str] = ("identifier",), parts: int | None = None, order: str = "arrival"
) -> DataFrame:
    """Ranges from_n..to_n of indices in 1..cnt that no fragment has; cnt as in `fragment_status`."""
    valid = fragments.filter(_usable())
    first = first_row(order, ["cnt"]) if order in fragments.columns else F.struct("cnt")
    slots = _without_strays(valid.groupBy(*by, "idx").agg(F.min(first).alias("_f")), by)
    # The index after the last one closes the range at the end of each file.
    ends = slots.groupBy(*by).agg(F.try_add(F.min("_f")["cnt"], F.lit(1)).alias("idx")).dropna(subset="idx")
    return number_gaps(slots.select(*by, "idx").unionByName(ends), by, "idx", parts)


def missing_fragments(
    fragments: DataFrame, by: Sequence[str] = ("identifier",), parts: int | None = None
) -> DataFrame:
    """One row per missing index."""
    pieces = missing_ranges(fragments, by, parts)
    for step in RANGE_STEPS:
        width = F.lit(step).cast("bigint")
        pieces = pieces.withColumn("from_n", F.explode(F.sequence("from_n", "to_n", width)))
        pieces = pieces.withColumn("to_n", F.least(F.col("from_n") + (width - 1), F.col("to_n")))
    return pieces.select(*by, F.col("from_n").alias("idx"))


def latest_attempt(
    fragments: DataFrame,
    path: Sequence[str] = ("path", "filename"),
    order: str = "arrival",
    parts: int | None = None,
) -> DataFrame:
    """Fragments of the current attempt: a new identifier on the same output path starts over.

    The runs are told from the keys alone; what comes back to the fragments is where each path's
    current attempt begins.
    """
    valid = fragments.filter(_usable())
    told = runs(valid.select(*path, "identifier", order), path, order, "identifier", parts)
    spread = [*path, order]
    # Written, as they are read twice. Where they are few they are broadcast, and payload stays in place.
    starts = salted(told, spread, LOOKUP_SALTS).groupBy(*path)
    starts = starts.agg(F.max("last_run_start").alias("_start"), F.collect_set("_salt").alias("_salts"))
    marked = salted_lookup(valid, settle(starts, "starts"), path, spread, "inner")
    return marked.filter(F.col(order) >= F.col("_start")).drop("_start")


def join_pieces(
    pieces: DataFrame, by: Sequence[str], position: str, payload: str, carried: Sequence[Column]
) -> DataFrame:
    """One row per key with the payloads in order of position; `pieces` has one row per position."""
    return pieces.groupBy(*by).agg(
        F.expr(f"listagg(`{payload}`, X'') WITHIN GROUP (ORDER BY `{position}`)").alias("content"),
        F.count(F.lit(1)).alias("seen"),
        *carried,
    )


def verified(files: DataFrame) -> DataFrame:
    """Set `state` of assembled rows and keep the payload of sound ones only.

    With a parent checksum, it decides, by `_digest` where payload did not fit a cell. Without one, the
    bytes must add up to the announced size, and the pieces to each other (`_sound`). A type that is not
    supported never passes.
    """
    whole = F.col("seen") == F.col("cnt")
    actual = F.coalesce(F.col("_digest"), digest_by(F.col("content"), F.col("orig_checksum_type")))
    right = actual == F.lower("orig_checksum")
    no_parent = F.coalesce(F.col("orig_checksum"), F.lit("")) == ""
    adds_up = F.col("_sound") & (F.col("orig_size").isNull() | (F.col("size") == F.col("orig_size")))
    state = (
        F.when(~whole, "incomplete")
        .when(no_parent & adds_up, "unverified")
        .when(no_parent, "corrupt")
        .when(F.coalesce(right, F.lit(False)), "complete")
        .otherwise("corrupt")
    )
    return files.withColumn("state", state).withColumn(
        "content", F.when(F.col("state").isin("complete", "unverified"), F.col("content"))
    )


def _fits(columns: Sequence[str]) -> Column:
    """Whether a file's pieces (`_length`, `offset`) lie where they say: all of one length but the last."""
    if "offset" not in columns:
        return F.lit(True)
    length = F.coalesce("_length", F.lit(0)).cast("bigint")
    inner = F.col("idx") < F.col("_f.cnt")
    here = F.when(inner, F.col("offset") == (F.col("idx") - 1) * length)
    last = F.when(~inner, F.col("offset") + length == F.col("_f.orig_size"))
    placed = F.coalesce(F.bool_and(F.coalesce(here, last, F.lit(True))), F.lit(True))
    alike = F.min(F.when(inner, length)) == F.max(F.when(inner, length))
    return placed & F.coalesce(alike, F.lit(True))


def told_apart(valid: DataFrame, by: Sequence[str], order: str, max_cell: int | None) -> DataFrame:
    """by..., ANNOUNCED, `_unclear` and `_large`: the files that need more than one look at their rows.

    `_unclear` ones have rows that name different counts, `_large` ones hold more than `max_cell` bytes. What
    counts is what the pieces really hold: lengths are summed, payload does not move. Both kinds are few.
    """
    rows = valid.select(*by, "idx", *ANNOUNCED, order, F.octet_length("part").alias("_length"))
    slots = rows.groupBy(*by, "idx").agg(
        F.min_by("_length", arrived_first(order)).alias("_length"),
        F.min(first_row(order)).alias("_f"),
        F.min("cnt").alias("_low"),
        F.max("cnt").alias("_high"),
    )
    sums = slots.groupBy(*by).agg(
        F.min("_f").alias("_f"),
        (F.min("_low") < F.max("_high")).alias("_unclear"),
        (F.coalesce(F.sum("_length"), F.lit(0)) > max_cell).alias("_large"),
    )
    chosen = sums.filter("_unclear OR _large")
    return settle(chosen.select(*by, *(F.col(f"_f.{c}").alias(c) for c in ANNOUNCED), "_unclear", "_large"), "told")


def reassemble(
    fragments: DataFrame,
    by: Sequence[str] = ("identifier",),
    order: str = "arrival",
    max_cell: int = MAX_CELL,
) -> DataFrame:
    """Complete files from their fragments, verified against the parent checksum.

    The first copy of each index counts; copies are dropped inside the map tasks, before anything
    moves. The first row to arrive says what the file is: its number of pieces, size and checksum. Rows
    come out as `complete`, `unverified` (the parent names no checksum) or `corrupt`; incomplete files are
    left out. A file of more than `max_cell` bytes gets the same verdict from a running digest over its
    ordered pieces; its `content` is null, and `ordered_pieces` hands out the payload.
    """
    valid = fragments.filter(_usable())
    told = told_apart(valid, by, order, max_cell)
    own = ["part", *(["offset"] if "offset" in fragments.columns else [])]
    pieces = valid.groupBy(*by, "idx").agg(
        F.min_by(F.struct(*own), arrived_first(order)).alias("_own"), F.min(first_row(order)).alias("_f")
    )
    pieces = join_null_safe(pieces, told.select(*by, F.col("cnt").alias("_cnt"), "_large"), by, "left")
    pieces = pieces.filter(F.col("_cnt").isNull() | (F.col("idx") <= F.col("_cnt")))
    pieces = pieces.select(*by, "idx", "_f", "_own.*", F.coalesce("_large", F.lit(False)).alias("_large"))
    pieces = pieces.withColumns(
        {"_length": F.octet_length("part").cast("bigint"), "part": F.when(~F.col("_large"), F.col("part"))}
    )
    carried = [
        F.min("_f").alias("_f"), F.coalesce(F.sum("_length"), F.lit(0)).alias("size"), _fits(own).alias("_sound")
    ]
    whole = join_pieces(pieces, by, "idx", "part", carried)
    whole = whole.select(*by, "content", "seen", "size", "_sound", *(F.col(f"_f.{c}").alias(c) for c in ANNOUNCED))
    large = told.filter("_large")
    if large.isEmpty():
        judged = whole.withColumn("_digest", F.lit(None).cast("string"))
    else:
        parts = valid.select(*by, "idx", "part", arrived_first(order).alias("_first"))
        large = large.select(*by, F.col("cnt").alias("_cnt"), F.col("orig_checksum_type").alias("_type"))
        parts = join_null_safe(parts, large, by).filter("idx <= _cnt")
        digests = settle(file_digests(parts, by, "idx", "part", "_type", F.col("_first")), "digests")
        digests = digests.select(*by, F.col("digest").alias("_digest"), F.lit(True).alias("_by_pieces"))
        judged = join_null_safe(whole, digests, by, "left")
        judged = judged.withColumn("content", F.when(F.col("_by_pieces").isNull(), F.col("content"))).drop("_by_pieces")
    return verified(judged).filter(F.col("state") != "incomplete").drop("seen", "_sound", "_digest")


def ordered_pieces(
    fragments: DataFrame, by: Sequence[str] = ("identifier",), order: str = "arrival"
) -> DataFrame:
    """Files of any size as a run of rows: by..., idx, part, then one row with state, size and digest.

    A file's rows lie in one partition, in order, its pieces first (their `state` is null); the last row
    has a null idx and says `complete`, `unverified`, `corrupt` or `incomplete`. A reader that writes pieces
    as they come holds one of them at a time and learns at the end whether the file may stay.
    """
    valid = fragments.filter(_usable())
    own = ["idx", *(["offset"] if "offset" in fragments.columns else [])]
    rows = valid.select(*by, *own, F.octet_length("part").alias("_length"), *ANNOUNCED, order)
    slots = rows.groupBy(*by, "idx").agg(
        F.min_by(F.struct("_length", *own[1:]), arrived_first(order)).alias("_own"), F.min(first_row(order)).alias("_f")
    )
    slots = _without_strays(slots, by).select(*by, "idx", "_f", "_own.*")
    facts = settle(slots.groupBy(*by).agg(F.min("_f").alias("_f"), _fits(own).alias("_sound")), "announced")
    facts = facts.select(file_key(by).alias("_name"), "_sound", *(F.col(f"_f.{c}").alias(c) for c in ANNOUNCED))
    told = valid.select(*by, "idx", "part", file_key(by).alias("_name"), arrived_first(order).alias("_first"))
    told = told.join(facts, "_name").filter(F.col("idx") <= F.col("cnt")).drop("_name")
    folded = fold_files(told, [*by, *ANNOUNCED, "_sound"], "idx", "part", "orig_checksum_type", F.col("_first"))
    no_parent = F.coalesce("orig_checksum", F.lit("")) == ""
    adds_up = F.col("_sound") & (F.col("orig_size").isNull() | (F.col("n_bytes") == F.col("orig_size")))
    state = (
        F.when(F.col("n_pieces") != F.col("cnt"), "incomplete")
        .when(no_parent, F.when(adds_up, "unverified").otherwise("corrupt"))
        .when(F.coalesce(F.col("digest") == F.lower("orig_checksum"), F.lit(False)), "complete")
        .otherwise("corrupt")
    )
    return folded.select(
        *by, "idx", "part", F.when(F.col("idx").isNull(), state).alias("state"), F.col("n_bytes").alias("size"), "digest"
    )
