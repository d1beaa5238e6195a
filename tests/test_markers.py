"""Staging, replay and relay by markers: one pass over the payload, and calls that may come again."""

from __future__ import annotations

import os

import pytest
from helpers import tuples
from pyspark.sql import functions as F
from test_operators import feed

from feedkit.plans.flows import forward_feed
from feedkit.plans.settle import settle
from feedkit.sources import relay, staging


def counted(spark, files):
    """The rows, and a counter of how often one of them is read."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return files.mapInArrow(look, files.schema), seen


@pytest.mark.parametrize("parts", [None, 3])
def test_staging_reads_the_feed_once(spark, tmp_path, parts):
    files, seen = counted(spark, settle(feed(spark), "in"))
    got = staging.stage_feed(files, str(tmp_path), batch_parts=parts)
    assert seen.value == 12 and got == {"files": 12, "bytes": 48, "failed": 2}
    assert {r["seq"] for r in staging.read_staged(spark, str(tmp_path)).collect()} == {1, 2, 3, 7, 8, 9}
    # Without buckets, rejected batches leave nothing behind.
    assert spark.read.parquet(f"{tmp_path}/payload").count() == (12 if parts else 6)


def test_relaying_reads_the_feed_once_and_equals_the_three_results(spark, tmp_path):
    for i, options in enumerate(({"pass_metrics": False, "remote": "r:1"}, {"pass_metrics": True}, {"skip": True})):
        files, seen = counted(spark, settle(feed(spark), "in"))
        relay.relay_feed(files, f"{tmp_path}/{i}", "RELAY", at=F.lit("t"), **options)
        assert seen.value == 12
        got = relay.read_relayed(spark, f"{tmp_path}/{i}")
        want = forward_feed(feed(spark), "RELAY", at=F.lit("t"), **options)
        for a, b in zip(got, want, strict=True):
            columns = [c for c in b.columns if c != "attrs"]
            text = F.to_json(F.array_sort(F.map_entries("attrs"))).alias("attrs")
            assert tuples(a.select(*columns, text), *columns, "attrs") == tuples(b.select(*columns, text), *columns, "attrs")


def test_a_micro_batch_that_runs_twice_changes_nothing(spark, tmp_path):
    feed(spark).repartition(3, "batch_id").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(feed(spark).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for checkpoint in ("a", "b"):  # a lost checkpoint begins anew
        for start, where in ((staging.stage_stream, "staged"), (relay.relay_stream, "relayed")):
            options = {"label": "RELAY"} if where == "relayed" else {}
            writer = start(stream, f"{tmp_path}/{where}", f"{tmp_path}/{where}-{checkpoint}", at=F.lit("t"), **options)
            writer.trigger(availableNow=True).start().awaitTermination()
    assert tuples(staging.read_staged(spark, f"{tmp_path}/staged"), "seq") == [(i,) for i in (1, 2, 3, 7, 8, 9)]
    out, rejects, metered = relay.read_relayed(spark, f"{tmp_path}/relayed")
    assert tuples(out, "seq") == [(i,) for i in (1, 2, 3, 7, 8, 9)] and tuples(metered, "seq") == [(12,)]
    assert tuples(rejects, "seq") == [(i,) for i in (10, 11, 12, 4, 5, 6)]


def test_a_call_that_broke_off_is_replaced(spark, tmp_path):
    """Payload without a marker: the call comes again, with other rows, and nothing is there twice."""
    folder = str(tmp_path)
    staging.stage_feed(feed(spark).filter("seq <= 3"), folder, call_id="one")
    markers = settle(spark.read.parquet(f"{folder}/markers"), "markers")
    staging._remove(spark, f"{folder}/markers")  # as if it had ended before the markers
    staging.stage_feed(feed(spark).filter("seq in (1, 2, 3, 7)"), folder, call_id="one")
    assert tuples(staging.read_staged(spark, folder), "seq") == [(1,), (2,), (3,), (7,)]
    assert markers.first()["stage_id"] == spark.read.parquet(f"{folder}/markers").first()["stage_id"]


def replayed(spark, folder, out, **options):
    writer = staging.replay_into(spark, folder, f"{out}/rows", f"{out}/cp", at=F.lit("t"), **options)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def test_replay_goes_by_markers(spark, tmp_path):
    folder = str(tmp_path / "s")
    nobatch = feed(spark).withColumn("batch_id", F.lit(None).cast("bigint")).withColumn("seq", F.col("seq") + 100)
    staging.stage_feed(feed(spark), folder, call_id="x")
    staging.stage_feed(feed(spark), folder, call_id="x")
    staging.stage_feed(nobatch, folder, batch_parts=2, keep_partial=True)
    orphan = settle(spark.read.parquet(f"{folder}/payload").withColumn("stage_id", F.lit("s0")), "orphan")
    orphan.write.mode("append").partitionBy("stage_id", "batch_part").parquet(f"{folder}/payload")
    want = [(i,) for i in [1, 2, 3, 7, 8, 9, *(100 + i for i in range(1, 13) if i % 5)]]
    got = replayed(spark, folder, tmp_path / "r", max_files_per_trigger=1)
    assert tuples(got, "seq") == sorted(want, key=repr)
    # More arrives while the replay is down.
    staging.stage_feed(feed(spark).withColumn("seq", F.col("seq") + 200), folder, call_id="y")
    assert replayed(spark, folder, tmp_path / "r").count() == len(want) + 6


def test_replay_reads_only_what_its_markers_name(spark, tmp_path):
    folder = str(tmp_path)
    for call in ("a", "b"):
        staging.stage_feed(feed(spark), folder, call_id=call)
    markers = spark.read.parquet(f"{folder}/markers").filter("call_id = 'a' AND batch_id = 0")
    rows = staging._payload_of(spark, folder, settle(markers, "m"), ["seq"])
    read = [f for f in rows.inputFiles() if "/payload/" in f]
    assert read and all(staging._call_name("a") in f and "batch_part=b0" in f for f in read)
    assert tuples(rows, "seq") == [(1,), (2,), (3,)]


def test_delivery_that_fails_comes_again(spark, tmp_path):
    folder, calls = str(tmp_path / "s"), []
    staging.stage_feed(feed(spark), folder)

    def deliver(rows, number):
        calls.append((number, sorted(r["seq"] for r in rows.collect())))
        if len(calls) == 1:
            raise RuntimeError("not now")

    def run():
        staging.replay_feed(spark, folder, deliver, str(tmp_path / "cp"), clean="delete").trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="not now"):
        run()
    run()
    assert calls == [(0, [1, 2, 3, 7, 8, 9])] * 2
    left = [f for _, _, names in os.walk(f"{folder}/payload") for f in names if f.endswith(".parquet")]
    assert left == []  # delivered, so it is gone


def test_delivered_folders_can_be_archived(spark, tmp_path):
    folder = str(tmp_path / "s")
    staging.stage_feed(feed(spark), folder, call_id="one")
    rows = replayed(spark, folder, tmp_path / "r", clean="archive", archive=str(tmp_path / "kept"))
    assert rows.count() == 6
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 6
    with pytest.raises(ValueError, match="clean"):
        staging.replay_feed(spark, folder, print, "x", clean="archive")
