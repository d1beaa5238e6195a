"""One odd row must neither end a job, nor vanish, nor take others with it."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from feedkit.functions.attributes import nanos
from feedkit.operators import custody, dedup, fragments, frames, sequence
from feedkit.operators.checksum import add_checksum
from feedkit.sources import staging
from feedkit.streaming import feeds

TOP = 2**63 - 1
FRAMES = "port int, uuid string, size bigint, offset bigint, mtu int, payload binary, arrival bigint"
FRAGMENTS = (
    "identifier string, idx bigint, cnt bigint, part binary, orig_size bigint, orig_checksum_type string, "
    "orig_checksum string, arrival bigint"
)


def test_frames_at_the_largest_offset(spark):
    rows = [(1, "a", 150, 0, 100, b"x" * 100, 1), (1, "a", 150, 100, 100, b"y" * 50, 2), (1, "a", 150, TOP, 100, b"z", 3), (1, "b", TOP, TOP - 1, 100, b"z", 4)]
    df = spark.createDataFrame(rows, FRAMES)
    assert ("a", 2, 2, 0, "complete") in tuples(frames.frame_status(df), "uuid", "total", "seen", "dups", "state")
    assert frames.run_status(df).count() == 2
    whole = tuples(frames.reassemble_frames(df), "uuid", "content", "assembly")
    assert whole == [("a", b"x" * 100 + b"y" * 50, "complete")]


def test_frames_that_do_not_fit_their_slots_are_corrupt(spark):
    rows = [(1, "a", 200, 0, 100, b"x" * 90, 1), (1, "a", 200, 100, 100, b"y" * 110, 2)]
    assert tuples(frames.reassemble_frames(spark.createDataFrame(rows, FRAMES)), "uuid", "assembly") == [("a", "corrupt")]


def test_frames_of_no_port_and_of_one_time(spark):
    rows = [(None, "a", 10, 0, 100, b"x" * 10, 1), (7, "b", 10, 0, 100, b"x" * 10, 5), (7, "b", 10, 0, 100, b"x" * 10, 5), (7, "c", 10, 0, 100, b"x" * 10, 5)]
    df = spark.createDataFrame(rows, FRAMES)
    assert tuples(frames.run_status(df), "port", "uuid", "state") == [(7, "b", "complete"), (7, "c", "complete"), (None, "a", "complete")]
    assert frames.inflight_runs(df).count() == 4


def test_a_stray_count_leaves_other_files_alone(spark):
    rows = [("f", 1, 2, b"a", 2, "", "", 1), ("f", 2, 2, b"b", 2, "", "", 2), ("g", 1, 2, b"a", 2, "", "", 1), ("g", 2, 2, b"b", TOP, "", "", 2), ("h", 1, TOP, b"q", TOP, "", "", 1)]
    df = spark.createDataFrame(rows, FRAGMENTS)
    got = tuples(fragments.reassemble(df), "identifier", "content", "state")
    assert got == [("f", b"ab", "unverified"), ("g", b"ab", "unverified")]
    assert fragments.fragment_status(df).count() == 3
    # A tiny cell: the same verdicts, payload in ordered pieces.
    small = tuples(fragments.reassemble(df, max_cell=1), "identifier", "content", "state")
    assert small == [(k, None, "unverified") for k in "fg"]
    assert fragments.missing_ranges(df).count() >= 0


def test_latest_attempt_without_a_name(spark):
    rows = [(None, "x", "i", 1, 2, 1), (None, "x", "j", 1, 2, 5), ("p", None, "k", 1, 2, 1)]
    df = spark.createDataFrame(rows, "path string, filename string, identifier string, idx bigint, cnt bigint, arrival bigint")
    assert tuples(fragments.latest_attempt(df), "identifier") == [("j",), ("k",)]


def test_times_beyond_64_bits_are_null(spark):
    texts = ["0001-01-01T00:00:00Z", "2263-01-01T00:00:00Z", "2024-01-02T03:04:05.000000006Z", "no time"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(nanos(F.col("t"))).collect()]
    assert got == [None, None, 1704164645000000006, None]
    attrs = {"custodyChain.0.action": "A", "custodyChain.0.time": texts[0]}
    row = custody.explode_hops(spark.createDataFrame([("u", attrs)], "uuid string, attrs map<string,string>")).first()
    assert (row["hop"], row["action"], row["ts_ns"]) == (0, "A", None)


def test_odd_hop_numbers_stay_as_they_are(spark):
    names = ["custodyChain.01.x", "custodyChain.1.x", f"custodyChain.{TOP}.x", "custodyChain.99999999999999999999.x", "custodyChain.x"]
    df = spark.createDataFrame([("u", {n: n for n in names})], "uuid string, attrs map<string,string>")
    got = custody.shift_chain(df, at=F.lit("t")).first()["attrs"]
    assert got == {n: n for n in names if n != names[1]} | {"custodyChain.2.x": names[1], "custodyChain.0.time": "t"}
    assert tuples(custody.explode_hops(df), "hop") == [(1,)]


def test_custody_operators_agree_on_repeated_and_unnamed_hops(spark):
    rows = [("u", 1, "A", 10), ("u", 0, "Z", 20), ("u", 0, "B", 30), ("v", 2, "A", 1), ("v", 1, None, 2), ("v", 0, "C", 3)]
    hops = spark.createDataFrame(rows, "uuid string, hop int, action string, ts_ns bigint")
    assert tuples(custody.custody_paths(hops), "path", "files") == [("A>>C", 1), ("A>B", 1)]
    pairs = tuples(custody.hop_pairs(hops), "uuid", "from_action", "to_action")
    assert pairs == [("u", "A", "B"), ("v", "", "C"), ("v", "A", "")]


def test_static_attributes_have_no_limit(spark):
    lines = spark.range(30_000).select(F.col("id").alias("pos"), (F.col("id") % 15_000).cast("string").alias("name"), F.col("id").cast("string").alias("value"))
    files = spark.createDataFrame([("u", {"7": "old"})], "uuid string, attrs map<string,string>")
    attrs = custody.attach_static_attrs(files, lines).first()["attrs"]
    assert len(attrs) == 15_000 and attrs["7"] == "15007"


def test_packets_of_one_time_come_out_once(spark):
    rows = [("s", 1, "", 1), ("s", 1, "", 1), ("s", 2, "EOF", 2), ("s", 2, "", 2), ("s", 3, "", 3)]
    df = spark.createDataFrame(rows, "socket_id string, n bigint, op string, arrival bigint")
    assert tuples(sequence.sequence_release(df), "n", "op") == [(1, ""), (2, "EOF")]


def test_content_without_a_checksum_type_is_linked(spark):
    rows = [(i, "d", f"f{i}", 5, None, "abc") for i in range(3)]
    df = spark.createDataFrame(rows, "seq bigint, path string, filename string, size bigint, checksum_type string, checksum string")
    assert tuples(dedup.dedup_to_links(df), "seq", "kind") == [(0, "file"), (1, "link"), (2, "link")]


@pytest.mark.parametrize("late_s", [250, 3000])
def test_late_rows_within_the_ttl_count(spark, tmp_path, late_s):
    """Piece 2 arrives in a later micro-batch, far behind the newest row."""
    schema = "path string, filename string, identifier string, idx bigint, cnt bigint, arrival bigint, arrived_at timestamp"
    base = dt.datetime(2024, 1, 1, 12)
    batches = [
        [("p", "f", "i", 1, 2, 1, base - dt.timedelta(seconds=late_s + 1)), ("p", "g", "j", 1, 2, 2, base)],
        [("p", "f", "i", 2, 2, 3, base - dt.timedelta(seconds=late_s))],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        feeds.run_available(feeds.stream_fragments(stream), str(tmp_path / "q"))
    out = spark.read.parquet(str(tmp_path / "q" / "out"))
    assert tuples(out, "filename", "event") == [("f", "completed")]


def test_staging_again_changes_nothing_and_keeps_files_without_a_batch(spark, tmp_path):
    rows = [(i, "d", f"f{i}", bytes([i]), 1, b, {}) for i, b in enumerate(("x", "x", None))]
    schema = "seq bigint, path string, filename string, content binary, size bigint, batch_id string, attrs map<string,string>"
    files = add_checksum(spark.createDataFrame(rows, schema))
    for call in ("one", "one", "two", "two"):
        staging.stage_feed(files, str(tmp_path / "s"), verify=False, batch_parts=2, call_id=call)
    got = tuples(staging.read_staged(spark, str(tmp_path / "s")), "seq", "batch_id")
    assert got == sorted([(0, "x"), (1, "x"), (2, None)] * 2, key=repr)


def test_frames_without_a_usable_mtu_carry_nothing(spark):
    rows = [(1, "a", 150, 0, 100, b"x" * 100, 1), (1, "a", 150, 100, 100, b"y" * 50, 2)]
    odd = [(1, "z", 150, 0, 0, b"x", 3), (1, "z", 150, 0, 99, b"x", 4), (1, "z", None, 0, 100, b"x", 5), (1, "z", 150, None, 100, b"x", 6), (1, "z", 150, 0, None, b"x", 7), (1, "z", -1, 0, 100, b"x", 8)]
    df = spark.createDataFrame([*rows, *odd], FRAMES)
    assert tuples(frames.frame_status(df), "uuid", "total", "seen", "state") == [("a", 2, 2, "complete")]
    assert tuples(frames.run_status(df), "uuid", "state") == [("a", "complete")]
    assert tuples(frames.reassemble_frames(df), "uuid", "content") == [("a", b"x" * 100 + b"y" * 50)]


def test_a_hop_is_stamped_where_there_are_no_attributes(spark):
    df = spark.createDataFrame([("u", None)], "uuid string, attrs map<string,string>")
    row = custody.stamp_hop(df, "RELAY", host="h", static={"team": "a"}, at=F.lit("t")).first()["attrs"]
    assert row == {"team": "a", "custodyChain.0.time": "t", "custodyChain.0.action": "RELAY", "custodyChain.0.local.hostname": "h"}
    assert custody.shift_chain(df, at=F.lit("t")).first()["attrs"] == {"custodyChain.0.time": "t"}
    assert custody.attach_static_attrs(df, {"k": "v"}).first()["attrs"] == {"k": "v"}


def test_a_packet_without_an_arrival_holds_back_those_behind_it(spark):
    rows = [("s", 1, "", 1), ("s", 2, "", None), ("s", 3, "", 3), ("t", 1, "", 5), ("t", 2, "", None), ("t", 2, "EOF", 6)]
    df = spark.createDataFrame(rows, "socket_id string, n bigint, op string, arrival bigint")
    assert tuples(sequence.sequence_release(df), "socket_id", "n", "op") == [("s", 1, ""), ("t", 1, ""), ("t", 2, "EOF")]
    assert tuples(sequence.sequence_gaps(df), "socket_id", "from_n", "to_n") == [("s", 2, 2)]


def test_rows_that_a_stream_cannot_place_are_rejected_not_fatal(spark, tmp_path):
    at = dt.datetime(2024, 1, 1, 12)

    def run(rows, schema, operator, name):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in")
        feeds.run_available(operator(spark.readStream.schema(schema).parquet(f"{folder}/in")), folder)
        return spark.read.parquet(f"{folder}/out")

    schema = "path string, filename string, identifier string, idx bigint, cnt bigint, arrival bigint, arrived_at timestamp"
    rows = [("p", "f", "i", 1, 2, 1, at), ("p", "f", "i", 2, 2, 2, at), ("p", "g", "i", None, 2, 3, at), ("p", "g", "i", 1, None, 4, at), ("p", "g", "i", 1, 2, None, at), ("p", "g", "i", 2, 2, 5, None)]
    got = run(rows, schema, feeds.stream_fragments, "fragments")
    assert tuples(got, "filename", "event") == [("f", "completed"), *[("g", "rejected")] * 4]
    schema = "port int, uuid string, size bigint, offset bigint, mtu int, payload binary, arrival bigint, arrived_at timestamp"
    rows = [(1, "a", 10, 0, 100, b"x" * 10, 1, at), (1, "b", 10, 0, 0, b"x", 2, at), (1, "c", None, 0, 100, b"x", 3, at), (1, "d", 10, 0, 100, b"x", None, at), (1, "e", 10, 0, 100, b"x", 4, None)]
    got = run(rows, schema, feeds.stream_frames, "frames")
    assert tuples(got, "uuid", "event") == [("a", "completed"), *[(u, "rejected") for u in "bcde"]]
    schema = "socket_id string, n bigint, op string, arrival bigint, arrived_at timestamp"
    rows = [("s", 1, "", 1, at), ("s", 2, "EOF", 2, at), ("", 1, "", 3, at), (None, 1, "", 3, at), ("t", None, "", 4, at), ("t", 0, "", 4, at), ("t", 1, "", None, at), ("t", 1, "", 5, None)]
    got = run(rows, schema, feeds.stream_sequence, "packets")
    assert sorted(r["event"] for r in got.collect()) == ["rejected"] * 6 + ["released"] * 2
