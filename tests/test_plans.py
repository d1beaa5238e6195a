"""What the plans move and read."""

from pyspark.sql import functions as F

from feedkit.catalog import views as v
from feedkit.operators import checksum as ck
from feedkit.operators.dedup import dedup_to_links
from feedkit.operators.fragments import fragment_status, latest_attempt
from feedkit.operators.frames import frame_status, run_status
from feedkit.operators.custody import explode_hops, stamp_hop
from feedkit.operators.sequence import release_plan
from feedkit.plans.settle import settle
from feedkit.plans.skew import salted_lookup
from feedkit.sources.files import scan_files
from helpers import exchanged_columns, plan_of

SF = "/root/testdata/sf0.001"


def staged_files(spark):
    files = ck.add_checksum(v.feed_files(v.table(spark, SF, "documents")))
    return settle(files.withColumn("attrs", F.create_map(F.lit("k"), F.lit("v"))), "plans")


def test_dedup_moves_keys_only(spark):
    files = staged_files(spark)
    moved = exchanged_columns(dedup_to_links(files).select("seq", "kind", "target", "size"))
    assert moved and not any("content" in line for line in moved)
    plan = plan_of(dedup_to_links(files).select("seq", "kind", "target", "size"))
    assert "Window" not in plan and "content:binary" not in plan


def test_gate_moves_keys_only(spark):
    judged = staged_files(spark).withColumn("accepted", F.col("seq") % 7 > 0)
    moved = exchanged_columns(ck.mark_batches(judged).select("seq", "batch_ok"))
    assert moved and not any("content" in line for line in moved)


def test_status_and_runs_move_no_payload(spark):
    files = staged_files(spark)
    fragments = settle(v.feed_fragments(files), "fragments")
    frames = settle(v.feed_frames(files).withColumn("length", F.octet_length("payload")), "frames")
    attempts = latest_attempt(fragments, order="arrival").select("identifier", "idx")
    for df in (fragment_status(fragments), attempts, frame_status(frames), run_status(frames)):
        assert not any("part#" in m or "payload" in m for m in exchanged_columns(df))
        assert "payload:binary" not in plan_of(df) and "part:binary" not in plan_of(df)
    talks = v.table(spark, SF, "conversations")
    packets = settle(v.feed_packets(talks, v.last_turns(talks)), "packets")
    assert not any("payload" in m for m in exchanged_columns(release_plan(packets)))


def test_custody_never_shuffles(spark):
    files = staged_files(spark).withColumn("uuid", F.col("seq"))
    assert "Exchange" not in plan_of(explode_hops(stamp_hop(files, "A", host="h")))


def test_scan_prunes_content_and_pushes_filters(spark):
    found = scan_files(spark, [SF]).filter("size > 5000").select("filepath", "size")
    plan = plan_of(found)
    assert "content" not in plan.split("ReadSchema", 1)[1].splitlines()[0]
    assert "GreaterThan(length,5000)" in plan


def test_small_lookups_broadcast_by_their_written_size(spark):
    files = staged_files(spark)
    small = settle(files.select("batch_id").distinct(), "small")
    plan = plan_of(salted_lookup(files, small, ["batch_id"], ["seq"], "left_anti"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = plan_of(salted_lookup(files, small, ["batch_id"], ["seq"], "left_anti"))
        assert "SortMergeJoin" in plan and "_salt" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cartesian_products(spark):
    from feedkit.catalog.queries import QUERIES

    quick = [n for n in QUERIES if not n.startswith("stream_") and n not in ("stage_feed", "replay_feed")]
    for name in quick:
        plan = plan_of(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
