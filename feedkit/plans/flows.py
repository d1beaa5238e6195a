"""Whole feeds, composed from the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.operators.checksum import RECEIVE, RELAY, Policy, add_checksum, verify_checksum
from feedkit.operators.custody import append_forwarded_for, stamp_hop
from feedkit.operators.dedup import dedup_to_links
from feedkit.operators.fragments import segment
from feedkit.operators.guards import mark_links, mark_paths, with_route
from feedkit.plans.settle import settle
from feedkit.plans.skew import salted_lookup


def with_gate(rows: DataFrame, scope: str, key: Sequence[str]) -> DataFrame:
    """Add `_gate`, the name of what passes or fails as one: the batch, or the single file."""
    own = F.concat_ws("/", F.lit("file"), *[F.col(k).cast("string") for k in key])
    if scope == "row":
        return rows.withColumn("_gate", own)
    batch = F.concat(F.lit("batch/"), F.col("batch_id").cast("string"))
    return rows.withColumn("_gate", F.coalesce(batch, own))


def judge(
    files: DataFrame, policy: Policy = RELAY, skip: bool = False, key: Sequence[str] = ("seq",)
) -> tuple[DataFrame, DataFrame]:
    """(verdicts, rejected): one row per file, and one row per rejected gate.

    Payload is read and hashed once here and does not move. Both results are written tables, so that
    a join with the rejected gates is a broadcast only where that table really is small.
    """
    checked = with_gate(verify_checksum(files, policy, skip), policy.scope, key)
    verdicts = settle(checked.select(*key, "batch_id", "_gate", "state", "accepted"), "verdicts")
    rejected = verdicts.filter("NOT accepted").select("_gate").distinct()
    return verdicts, settle(rejected, "rejected")


def split_by_gate(
    rows: DataFrame, rejected: DataFrame, scope: str, key: Sequence[str] = ("seq",)
) -> tuple[DataFrame, DataFrame]:
    """(ok, rejects) of rows by their rejected gates; payload stays in place if those are few."""
    gated = with_gate(rows, scope, key)
    ok = salted_lookup(gated, rejected, ["_gate"], key, "left_anti")
    bad = salted_lookup(gated, rejected, ["_gate"], key, "left_semi")
    return ok.drop("_gate"), bad.drop("_gate")


def mark_by_gate(
    rows: DataFrame, rejected: DataFrame, scope: str, key: Sequence[str] = ("seq",)
) -> DataFrame:
    """Rows with `batch_ok`, false where their gate was rejected, in one pass."""
    flagged = rejected.withColumn("_bad", F.lit(True))
    marked = salted_lookup(with_gate(rows, scope, key), flagged, ["_gate"], key, "left")
    return marked.withColumn("batch_ok", F.col("_bad").isNull()).drop("_gate", "_bad")


def forward_feed(
    files: DataFrame,
    label: str,
    policy: Policy = RELAY,
    skip: bool = False,
    remote: str | Column | None = None,
    host: str | Column | None = None,
    request: Mapping[str, Column | str] | None = None,
    pass_metrics: bool = True,
    at: Column | None = None,
    key: Sequence[str] = ("seq",),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Relay a feed: (out, rejects, metrics).

    Meter rows go to the third result and travel on only with `pass_metrics`. Files are stamped,
    get the remote address in front of `forwarded_for`, and pass if the policy accepts them; with
    scope `post`, one failure rejects its whole batch.
    """
    routed = with_route(files)
    metered = routed.filter(F.col("route") == "metrics").drop("route")
    carried = routed if pass_metrics else routed.filter(F.col("route") != "metrics")
    carried = carried.drop("route")
    stamped = stamp_hop(carried, label, host=host, request=request, at=at)
    if remote is not None:
        stamped = append_forwarded_for(stamped, remote)
    if skip:
        return stamped, stamped.filter(F.lit(False)), metered
    _, rejected = judge(carried, policy, key=key)
    out, rejects = split_by_gate(stamped, rejected, policy.scope, key)
    return out, rejects, metered


def outgoing_feed(
    files: DataFrame,
    max_size: int = 0,
    label: str = "SENDER",
    host: str | Column | None = None,
    algo: str = "SHA256",
    dedup: bool = True,
    at: Column | None = None,
) -> DataFrame:
    """Stamp, checksum, link repeated content and cut large files.

    A first pass writes the checksums as a narrow table and tells the links from it. The second one
    hashes again instead of moving payload: it joins the links only, which are broadcast where few.
    """
    stamped = add_checksum(stamp_hop(files, label, host=host, at=at), algo)
    if dedup:
        narrow = add_checksum(files, algo)
        narrow = narrow.select("seq", "path", "filename", "size", "checksum_type", "checksum")
        found = dedup_to_links(settle(narrow, "checksums")).filter(F.col("kind") == "link")
        links = settle(found.select("seq", "target"), "links")
        stamped = stamped.drop("target").join(links, "seq", "left")
        is_link = F.col("target").isNotNull()
        stamped = stamped.withColumns(
            {
                "kind": F.when(is_link, "link").otherwise(F.col("kind")),
                "size": F.when(is_link, F.lit(0)).otherwise(F.col("size")).cast("bigint"),
                "content": F.when(~is_link, F.col("content")),
            }
        )
    return segment(stamped, max_size, algo)


def incoming_feed(
    files: DataFrame, policy: Policy = RECEIVE, strict_filename: bool = True
) -> DataFrame:
    """Judge received rows in one pass: adds route, clean_path, state and outcome.

    outcome is `stored`, `rejected` (unsafe path, unknown kind or bad checksum), `dropped` (unsafe
    link) or `metered`. Write it partitioned by outcome to split the feed.
    """
    rows = with_route(mark_paths(files, strict_filename))
    rows = mark_links(rows if "target" in rows.columns else rows.withColumn("target", F.lit("")))
    rows = verify_checksum(rows, policy)
    is_link, is_file = F.col("route") == "link", F.col("route") == "file"
    outcome = (
        F.when(~F.col("path_ok") | (F.col("route") == "reject"), "rejected")
        .when(F.col("route") == "metrics", "metered")
        .when(is_link & ~F.col("link_ok"), "dropped")
        .when(is_file & ~F.col("accepted"), "rejected")
        .otherwise("stored")
    )
    return rows.withColumn("outcome", outcome).drop("path_ok", "link_ok", "resolved", "accepted")
