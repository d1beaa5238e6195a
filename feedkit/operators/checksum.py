"""Add and verify payload checksums, and judge whole batches by them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.hashing import digest, digest_by
from feedkit.plans.skew import SALTS, attach_group_facts


@dataclass(frozen=True)
class Policy:
    """What to do with rows that do not simply pass.

    on_missing, on_fail: "accept" or "reject". An unsupported checksum type counts as a failure.
    empty: "verify" treats empty payloads like others, "accept_missing" lets them in without a
    checksum, "unchecked" lets them in unseen.
    scope: "row" judges each file, "post" the whole batch.
    """

    on_missing: str = "reject"
    on_fail: str = "reject"
    empty: str = "verify"
    scope: str = "row"


AUDIT = Policy(on_missing="accept", on_fail="accept")
RELAY = Policy(on_missing="accept", scope="post")
TO_FRAMES = Policy(empty="accept_missing")
FROM_FRAMES = Policy(empty="unchecked")
STAGE = Policy(scope="post")
RECEIVE = Policy()
UNCHECKED = Policy(on_missing="accept", on_fail="accept", empty="unchecked")


def add_checksum(
    files: DataFrame, algo: str = "SHA256", only_if_missing: bool = False, content: str = "content"
) -> DataFrame:
    """Set checksum_type and checksum from the payload.

    With `only_if_missing`, rows that name a checksum type and empty payloads stay as they are.
    """
    value, kind = digest(F.col(content), algo), F.lit(algo)
    if only_if_missing:
        wanted = (F.coalesce("checksum_type", F.lit("")) == "") & (F.col("size") > 0)
        value = F.when(wanted, value).otherwise(F.col("checksum"))
        kind = F.when(wanted, kind).otherwise(F.col("checksum_type"))
    return files.withColumns({"checksum": value, "checksum_type": kind})


def checksum_state(content: Column, checksum_type: Column, checksum: Column, actual: Column | None = None) -> Column:
    """`pass`, `fail`, `missing` or `unsupported`; a digest that is known already stands for the payload's."""
    absent = (F.coalesce(checksum, F.lit("")) == "") | (F.coalesce(checksum_type, F.lit("")) == "")
    hashed = digest_by(content, checksum_type)
    actual = hashed if actual is None else F.coalesce(actual, hashed)
    return (
        F.when(absent, "missing")
        .when(actual.isNull(), "unsupported")
        .when(actual == F.lower(checksum), "pass")
        .otherwise("fail")
    )


def verify_checksum(
    files: DataFrame,
    policy: Policy = RECEIVE,
    skip: bool = False,
    content: str = "content",
    actual: Column | None = None,
) -> DataFrame:
    """Add `state` and, by the policy, `accepted`.

    `actual` may bring digests of payloads that are not in a cell; where it is null, the payload is hashed.

    A link has no payload of its own: its checksum describes the file that it stands for, so it is
    `unchecked` here and `resolve_links` brings the two together.
    """
    if skip:
        return files.withColumns({"state": F.lit("skipped"), "accepted": F.lit(True)})
    empty = F.col("size") == 0
    payload = F.coalesce(F.col(content), F.lit(b""))
    state = checksum_state(payload, F.col("checksum_type"), F.col("checksum"), actual)
    unseen = F.lit(False) if policy.empty != "unchecked" else empty
    if "kind" in files.columns:
        unseen = unseen | (F.coalesce("kind", F.lit("")) == "link")
    state = F.when(unseen, "unchecked").otherwise(state)
    missing_ok = F.lit(policy.on_missing == "accept")
    if policy.empty == "accept_missing":
        missing_ok = missing_ok | empty
    accepted = (
        F.when(F.col("state").isin("pass", "unchecked"), True)
        .when(F.col("state") == "missing", missing_ok)
        .otherwise(F.lit(policy.on_fail == "accept"))
    )
    return files.withColumn("state", state).withColumn("accepted", accepted)


def audit_feed(files: DataFrame) -> DataFrame:
    """Verify everything, reject nothing: files and bytes by state."""
    return (
        verify_checksum(files, AUDIT)
        .groupBy("state")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
    )


def mark_batches(
    files: DataFrame,
    batch: str = "batch_id",
    accepted: str = "accepted",
    spread_on: Sequence[str] = ("seq",),
    salts: int = SALTS,
) -> DataFrame:
    """Add `batch_ok`: false on every file of a batch that holds one rejected file."""
    bad = ~F.coalesce(F.col(accepted), F.lit(False))
    marked = attach_group_facts(
        files,
        [batch],
        [F.max(bad.cast("int")).alias("_bad")],
        spread_on,
        refine=lambda facts: facts.filter((F.col("_bad") == 1) & F.col(batch).isNotNull()),
        salts=salts,
    )
    # A row without a batch forms its own batch, so a bad one still fails.
    ok = F.col("_bad").isNull() & ~(F.col(batch).isNull() & bad)
    return marked.withColumn("batch_ok", ok).drop("_bad")


def batch_gate(
    files: DataFrame, batch: str = "batch_id", spread_on: Sequence[str] = ("seq",)
) -> tuple[DataFrame, DataFrame]:
    """(ok, rejects): one bad file rejects its whole batch."""
    marked = mark_batches(files, batch, spread_on=spread_on)
    return marked.filter("batch_ok"), marked.filter("NOT batch_ok")
