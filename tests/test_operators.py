"""Policies, gates, staging, flows and hot groups."""

import hashlib

import pytest
from pyspark.sql import functions as F

from feedkit.functions.attributes import get_attr, literal_attrs
from feedkit.operators import checksum as ck
from feedkit.operators.dedup import dedup_savings, dedup_to_links
from feedkit.operators.fragments import fragment_status, reassemble
from feedkit.operators.frames import frame_header, parse_frames
from feedkit.operators.guards import ROUTES, route_by_kind
from feedkit.operators.metrics import feed_metrics, merge_metrics, size_histogram
from feedkit.operators.sequence import numbered_packets
from feedkit.plans.flows import forward_feed, incoming_feed, outgoing_feed
from feedkit.plans.settle import drop_settled, settle, shared_folder
from feedkit.plans.skew import attach_group_facts, salted_lookup
from feedkit.sources import staging as stg
from feedkit.sources.synth import synth_feed
from feedkit.streaming.feeds import run_available
from helpers import tuples

SHA = hashlib.sha256(b"body").hexdigest()
EMPTY = hashlib.sha256(b"").hexdigest()

CASES = [
    # seq, content, type, checksum, state
    (1, b"body", "SHA256", SHA, "pass"),
    (2, b"body", "sha-256", SHA.upper(), "pass"),
    (3, b"body", "SHA1", hashlib.sha1(b"body").hexdigest(), "pass"),
    (4, b"body", "MD5", hashlib.md5(b"body").hexdigest(), "pass"),
    (5, b"body", "SHA512", hashlib.sha512(b"body").hexdigest(), "pass"),
    (6, b"body", "SHA256", EMPTY, "fail"),
    (7, b"body", "CRC32", "0", "unsupported"),
    (8, b"body", None, SHA, "missing"),
    (9, b"body", "SHA256", "", "missing"),
    (10, b"", None, None, "missing"),
    (11, b"", "SHA256", EMPTY, "pass"),
    (12, b"", "SHA256", SHA, "fail"),
    (13, None, "SHA256", EMPTY, "pass"),
]


def checksum_rows(spark):
    rows = [(s, bytearray(c) if c is not None else None, len(c or b""), t, k, s // 4) for s, c, t, k, _ in CASES]
    return spark.createDataFrame(
        rows, "seq bigint, content binary, size bigint, checksum_type string, checksum string, batch_id bigint"
    )


def test_checksum_states(spark):
    got = ck.verify_checksum(checksum_rows(spark), ck.AUDIT)
    assert {r["seq"]: r["state"] for r in got.collect()} == {s: w for s, *_, w in CASES}
    assert all(r["accepted"] for r in got.collect())


@pytest.mark.parametrize(
    ("policy", "rejected"),
    [
        (ck.AUDIT, set()),
        (ck.RELAY, {6, 7, 12}),
        (ck.STAGE, {6, 7, 8, 9, 10, 12}),
        (ck.RECEIVE, {6, 7, 8, 9, 10, 12}),
        (ck.TO_FRAMES, {6, 7, 8, 9, 12}),
        (ck.FROM_FRAMES, {6, 7, 8, 9}),
    ],
)
def test_policies(spark, policy, rejected):
    got = ck.verify_checksum(checksum_rows(spark), policy)
    assert {r["seq"] for r in got.filter("NOT accepted").collect()} == rejected


def test_skip_accepts_unseen(spark):
    got = ck.verify_checksum(checksum_rows(spark), ck.STAGE, skip=True).drop("content")
    assert {(r["state"], r["accepted"]) for r in got.collect()} == {("skipped", True)}


def test_one_bad_file_rejects_its_batch(spark):
    judged = ck.verify_checksum(checksum_rows(spark), ck.RELAY)
    loose = judged.withColumn("batch_id", F.when(F.col("seq") > 3, F.col("batch_id")))
    ok, bad = ck.batch_gate(judged)
    assert {r["seq"] for r in ok.collect()} == {1, 2, 3, 8, 9, 10, 11}
    assert {r["seq"] for r in bad.collect()} == {4, 5, 6, 7, 12, 13}
    # Files without a batch stand for themselves.
    alone = loose.withColumn("accepted", F.col("seq") != 2)
    ok, bad = ck.batch_gate(alone.filter("seq <= 3"))
    assert ({r["seq"] for r in ok.collect()}, {r["seq"] for r in bad.collect()}) == ({1, 3}, {2})


def test_add_checksum_only_if_missing(spark):
    got = ck.add_checksum(checksum_rows(spark), "SHA1", only_if_missing=True)
    types = {r["seq"]: r["checksum_type"] for r in got.collect()}
    assert types[8] == "SHA1" and types[10] is None and types[1] == "SHA256"
    with pytest.raises(ValueError):
        ck.add_checksum(checksum_rows(spark), "CRC32")


def hot_files(spark, n=3000):
    """A third of all rows have one content, and one batch holds two thirds."""
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 < 2, F.lit(0)).otherwise(F.col("id")).alias("batch_id"),
        F.lit("d/").alias("path"),
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("filename"),
        F.lit(4).cast("bigint").alias("size"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).cast("binary").alias("content"),
        F.lit("src").alias("source"),
    )


def test_hot_content_becomes_links(spark):
    deduped = dedup_to_links(ck.add_checksum(hot_files(spark)))
    links = deduped.filter("kind = 'link'")
    assert links.count() == 999 and {r["target"] for r in links.select("target").distinct().collect()} == {"f0"}
    saved = dedup_savings(deduped).first()
    assert (saved["files"], saved["links"], saved["bytes_saved"]) == (3000, 999, 999 * 4)


def test_hot_groups_spread_over_partitions(spark):
    rows = hot_files(spark, 6000).select("seq", "batch_id")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = attach_group_facts(rows, ["batch_id"], [F.count(F.lit(1)).alias("n")], ["seq"])
        assert facts.filter("batch_id = 0 AND n = 4000").count() == 4000
        per_part = facts.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in per_part) < 2500
        lookup = spark.createDataFrame([(0,)], "batch_id bigint")
        assert salted_lookup(rows, lookup, ["batch_id"], ["seq"], "left_semi").count() == 4000
        assert salted_lookup(rows, lookup, ["batch_id"], ["seq"], "left_anti").count() == 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_leaves_empty_and_unhashed_files_alone(spark):
    rows = [(0, "a", "x", 0, "S", "k"), (1, "a", "y", 0, "S", "k"), (2, "a", "z", 5, None, None), (3, "a", "w", 5, None, None),
            (4, "/r", "p", 5, "S", "q"), (5, "r", "p", 5, "S", "q"), (6, "/r", "o", 5, "S", "q")]
    df = spark.createDataFrame(
        rows, "seq bigint, path string, filename string, size bigint, checksum_type string, checksum string"
    )
    got = {r["seq"]: (r["kind"], r["target"]) for r in dedup_to_links(df).collect()}
    # No relative path leads from r to /r, so that copy is sent whole.
    assert got == {i: ("file", None) for i in range(6)} | {6: ("link", "p")}
    off = dedup_to_links(df, dedup=False)
    assert {r["kind"] for r in off.collect()} == {"file"}


def test_routes(spark):
    df = spark.createDataFrame([("",), (None,), ("file",), ("dir",), ("link",), ("metrics",), ("pipe",)], "kind string")
    routed = route_by_kind(df)
    assert {k: r.count() for k, r in routed.items()} == {"file": 3, "dir": 1, "link": 1, "metrics": 1, "reject": 1}
    assert tuple(routed) == ROUTES


def test_reassemble_goes_by_the_checksum(spark):
    whole = b"abcdef"
    sha = hashlib.sha256(whole).hexdigest()

    def piece(ident, idx, part, check, size=6, kind="SHA256"):
        return (ident, idx, 2, bytearray(part), size, kind, check, idx)

    rows = [piece("good", 1, b"abc", sha), piece("good", 2, b"def", sha)]
    rows += [piece("bad", 1, b"abc", sha), piece("bad", 2, b"xyz", sha)]
    rows += [piece("open", 1, b"abc", sha)]
    rows += [piece("big", 1, b"abc", sha, size=10**12), piece("big", 2, b"def", sha, size=10**12)]
    rows += [piece("odd", 1, b"abc", sha, kind="CRC"), piece("odd", 2, b"def", sha, kind="CRC")]
    rows += [piece("plain", 1, b"abc", None), piece("plain", 2, b"def", None)]
    df = spark.createDataFrame(
        rows, "identifier string, idx bigint, cnt bigint, part binary, orig_size bigint, "
        "orig_checksum_type string, orig_checksum string, arrival bigint"
    )
    got = {r["identifier"]: (r["state"], r["content"]) for r in reassemble(df).collect()}
    assert {k: s for k, (s, _) in got.items()} == {
        "good": "complete", "bad": "corrupt", "big": "complete", "odd": "corrupt", "plain": "unverified",
    }
    # A wrong size announced does not count against a right checksum.
    assert bytes(got["good"][1]) == bytes(got["big"][1]) == whole and got["bad"][1] is None
    lone = spark.createDataFrame([("one", 1, 1)], "identifier string, idx bigint, cnt bigint")
    assert fragment_status(lone).count() == 0


def test_frames_parse_and_reject(spark):
    rows = [
        ("good", "00112233445566778899aabbccddeeff", 5, 0, 1472, b"hello"),
        ("header", "00112233445566778899aabbccddeeff", 5, 0, 1472, b""),
        ("tiny", "00112233445566778899aabbccddeeff", 5, 0, 99, b"hello"),
    ]
    df = spark.createDataFrame(
        [(n, u, s, o, m, bytearray(p)) for n, u, s, o, m, p in rows],
        "name string, u string, s bigint, o bigint, m int, p binary",
    )
    data = df.select("name", F.concat(frame_header(F.col("u"), F.col("s"), F.col("o"), F.col("m")), F.col("p")).alias("data"))
    huge = bytes(16) + b"\xff" * 8 + bytes(8) + (1472).to_bytes(2, "big") + b"x"
    extra = spark.createDataFrame([("huge", bytearray(huge)), ("cut", bytearray(33))], "name string, data binary")
    got = {r["name"]: r for r in parse_frames(data.unionByName(extra)).collect()}
    assert set(got) == {"good", "header"}
    assert got["good"]["uuid"] == "00112233-4455-6677-8899-aabbccddeeff"
    assert (got["good"]["size"], got["good"]["mtu"], bytes(got["good"]["payload"])) == (5, 1472, b"hello")
    assert got["header"]["payload"] is None and got["header"]["length"] == 0


def test_packets_need_a_session_and_a_number(spark):
    rows = [("s", "1"), ("s", "x"), ("", "1"), (None, "1"), ("s", "-1"), ("s", None), ("s", "99999999999999999999")]
    ok, rejects = numbered_packets(spark.createDataFrame(rows, "socket_id string, n string"))
    assert tuples(ok, "socket_id", "n") == [("s", 1)]
    assert rejects.count() == 6


def test_meters(spark):
    df = spark.createDataFrame(
        [("h", "A", "2024-01-01 00:01:00", s, 1) for s in (0, 9, 10, 99, 100)] + [("h", "A", "2024-01-01 00:05:00", 7, 2)],
        "host string, action string, t string, size bigint, files bigint",
    ).withColumn("ts", F.col("t").cast("timestamp"))
    assert tuples(size_histogram(df, [10, 100]), "bucket", "n") == [(0, 4), (1, 2), (2, 1)]
    assert tuples(feed_metrics(df), "files", "bytes") == [(2, 7), (5, 218)]
    report, sent = merge_metrics(df.filter("files = 1"), df.filter("files = 2"), pass_through=False)
    assert tuples(report, "files", "bytes") == [(2, 7), (5, 218)] and sent.count() == 0
    assert merge_metrics(df, df)[1].count() == 6


def feed(spark):
    rows = [(i, b"body" if i % 5 else b"evil") for i in range(1, 13)]
    return spark.createDataFrame([(i, bytearray(c)) for i, c in rows], "seq bigint, content binary").select(
        "seq",
        F.expr("(seq - 1) div 3").alias("batch_id"),
        F.when(F.col("seq") == 12, "metrics").otherwise("file").alias("kind"),
        F.lit("d").alias("path"),
        F.concat(F.lit("f"), F.col("seq").cast("string")).alias("filename"),
        F.lit(4).cast("bigint").alias("size"),
        "content",
        F.lit("SHA256").alias("checksum_type"),
        F.lit(SHA).alias("checksum"),
        literal_attrs({"path": "d"}).alias("attrs"),
    )


def test_forwarding(spark):
    out, rejects, metered = forward_feed(feed(spark), "RELAY", remote="r:1", pass_metrics=False, at=F.lit("t"))
    assert {r["seq"] for r in out.collect()} == {1, 2, 3, 7, 8, 9}
    assert {r["seq"] for r in rejects.collect()} == {4, 5, 6, 10, 11}
    assert {r["seq"] for r in metered.collect()} == {12}
    row = out.first()
    assert row["forwarded_for"] == "r:1" and row["attrs"]["custodyChain.0.action"] == "RELAY"
    out, rejects, _ = forward_feed(feed(spark), "RELAY", ck.RECEIVE, at=F.lit("t"))
    assert {r["seq"] for r in rejects.collect()} == {5, 10} and out.count() == 10
    out, rejects, _ = forward_feed(feed(spark), "RELAY", skip=True)
    assert (out.count(), rejects.count()) == (12, 0)


def test_staging_round_trip(spark, tmp_path):
    folder = str(tmp_path / "stage")
    stg.stage_feed(feed(spark), folder, host="h", at=F.lit("t"))
    stg.stage_feed(feed(spark).withColumn("seq", F.col("seq") + 100).withColumn("batch_id", F.col("batch_id") + 50), folder, batch_parts=4)
    back = stg.read_staged(spark, folder)
    assert {r["seq"] for r in back.collect()} == {1, 2, 3, 7, 8, 9, 101, 102, 103, 107, 108, 109}
    assert {r["s"] for r in back.select(get_attr(F.col("attrs"), "size").alias("s")).collect()} == {"4"}
    replayed = str(tmp_path / "replay")
    writer = stg.replay_into(spark, folder, f"{replayed}/out", replayed, host="h2", at=F.lit("t2"), max_files_per_trigger=1)
    writer.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{replayed}/out").collect()
    assert len(rows) == 12
    assert {(r["attrs"]["custodyChain.0.action"], r["attrs"]["custodyChain.1.action"]) for r in rows} == {("FROM-DISK", "TO-DISK")}


def test_payload_without_marker_is_not_read(spark, tmp_path):
    folder = str(tmp_path / "stage")
    stg.stage_feed(feed(spark), folder, verify=False)
    orphan = spark.read.parquet(f"{folder}/payload").withColumn("stage_id", F.lit("broken off"))
    settled = settle(orphan, "orphan")
    settled.write.mode("append").partitionBy("stage_id", "batch_part").parquet(f"{folder}/payload")
    assert spark.read.parquet(f"{folder}/payload").count() == 24
    assert stg.read_staged(spark, folder).count() == 12


def test_partial_batches_can_be_kept(spark, tmp_path):
    folder = str(tmp_path / "stage")
    stg.stage_feed(feed(spark), folder, keep_partial=True)
    assert spark.read.parquet(f"{folder}/payload").count() == 12
    assert stg.read_staged(spark, folder).count() == 6


def test_hook_runs_after_commit(spark, tmp_path):
    folder, seen = str(tmp_path / "stage"), []
    stg.stage_feed(feed(spark), folder)
    schema = spark.read.parquet(f"{folder}/payload").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/payload")
    query = stg.on_complete(stream, lambda df, n: seen.append((n, df.count())), str(tmp_path / "cp"), True).start()
    query.awaitTermination()
    assert sum(c for _, c in seen) == 6


def test_outgoing_then_incoming(spark):
    files = feed(spark).filter("kind = 'file'").withColumn("content", F.concat("content", F.repeat(F.lit("z"), 10).cast("binary")))
    files = files.withColumn("size", F.octet_length("content").cast("bigint"))
    sent = outgoing_feed(files, 8, host="h", at=F.lit("t"))
    kinds = {r["kind"]: r["count"] for r in sent.groupBy("kind").count().collect()}
    # Two contents: two files in two fragments each, and nine links.
    assert kinds == {"file": 4, "link": 9}
    got = incoming_feed(sent)
    assert {(r["outcome"], r["count"]) for r in got.groupBy("outcome").count().collect()} == {("stored", 13)}
    plain = outgoing_feed(files, 0, dedup=False)
    assert plain.count() == 11


def test_synthetic_feed(spark):
    made = synth_feed(spark, 5, 10, 20, name_format="x%03d", at=F.lit("t"))
    rows = made.orderBy("seq").collect()
    assert [r["filename"] for r in rows] == ["x000", "x001", "x002", "x003", "x004"]
    for r in rows:
        assert 10 <= r["size"] < 20 and bytes(r["content"]) == bytes(r["size"])
        assert r["checksum"] == hashlib.sha1(bytes(r["size"])).hexdigest()
    assert {r["size"] for r in synth_feed(spark, 3, 7, 7).collect()} == {7}
    assert synth_feed(spark, 2, 0, 0).first()["checksum"] is None
    assert synth_feed(spark, 0, 1, 2).isStreaming
    with pytest.raises(ValueError):
        synth_feed(spark, 1, 5, 4)


def test_shared_folder_is_below_the_configured_one(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_settled_tables_can_be_dropped(spark):
    kept = settle(spark.range(10).toDF("seq"), "dropped")
    assert kept.count() == 10
    assert drop_settled(spark) >= 1
    assert drop_settled(spark) == 0
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
