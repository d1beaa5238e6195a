"""One query per operator: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit import model
from feedkit.catalog import views as v
from feedkit.functions import attributes as at
from feedkit.functions.attributes import get_attr, literal_attrs
from feedkit.operators import bitmaps as bm
from feedkit.operators import checksum as ck
from feedkit.operators import custody as cu
from feedkit.operators import dedup as dd
from feedkit.operators import fragments as fr
from feedkit.operators import frames as fm
from feedkit.operators import guards as gd
from feedkit.operators import metrics as mt
from feedkit.operators import sequence as sq
from feedkit.plans import flows
from feedkit.plans.settle import settle, shared_folder
from feedkit.plans.skew import join_null_safe
from feedkit.session import prepare
from feedkit.sources import files as src
from feedkit.sources import ranges as rg
from feedkit.sources import relay as rl
from feedkit.sources import staging as st
from feedkit.sources import store as so
from feedkit.sources import synth as sy
from feedkit.streaming import feeds as sf

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STAMP = "2024-01-01T00:00:00.000000001Z"
#: Payload in a file of a feed that arrives.
ARRIVING_BYTES = 128 << 20


def query(fn: Query) -> Query:
    """Register under the function's name."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = prepared
    return fn


def _files(spark, sf_dir):
    return v.feed_files(v.table(spark, sf_dir, "documents"))


def _fragments(spark, sf_dir):
    return v.feed_fragments(_files(spark, sf_dir))


def _frames(spark, sf_dir):
    return v.feed_frames(_files(spark, sf_dir)).filter("NOT lost")


def _packets(spark, sf_dir):
    talks = v.table(spark, sf_dir, "conversations")
    return v.feed_packets(talks, v.last_turns(talks)).filter("NOT lost").drop("lost")


def _hops(spark, sf_dir):
    return v.feed_hops(v.table(spark, sf_dir, "events"))


def _chains(spark, sf_dir):
    return v.feed_chains(_hops(spark, sf_dir))


def _hashed(files):
    """Narrow rows with fresh checksums, written once so that payload is hashed once."""
    return settle(ck.add_checksum(files).drop("content"), "checksums")


def _pairs(chains):
    return chains.select("uuid", F.explode("attrs").alias("name", "value"))


def _sha(column):
    return F.sha2(column, 256)


# Scans, sources, sinks


@query
def source_report(spark, sf_dir):
    """Per source: what verifies, what is repeated, and what links would save."""
    files = _files(spark, sf_dir)
    judged = ck.verify_checksum(files, ck.AUDIT).withColumn("given", F.col("state"))
    narrow = settle(ck.add_checksum(judged).drop("content"), "checksums")
    deduped = dd.dedup_to_links(narrow)
    linked = F.col("kind") == "link"
    return deduped.groupBy("source").agg(
        F.count(F.lit(1)).alias("files"),
        *[F.sum((F.col("given") == s).cast("bigint")).alias(f"n_{s}") for s in ("pass", "fail", "missing")],
        F.sum(linked.cast("bigint")).alias("links"),
        F.sum(F.when(linked, F.col("orig_size")).otherwise(F.lit(0))).alias("bytes_saved"),
    )


def _stored(spark, sf_dir):
    """The documents as files of a folder; every 31st one is empty."""
    folder = shared_folder(spark, "files")
    files = _files(spark, sf_dir)
    files = files.withColumn("content", F.when(F.expr("seq % 31 <> 0"), F.col("content")))
    settle(so.store_files(files, folder), "stored")
    return folder


@query
def scan_files(spark, sf_dir):
    """Files of known contents, read back in byte ranges of a thousand bytes."""
    folder = _stored(spark, sf_dir)
    found = src.scan_files(spark, [folder], range_bytes=1000)
    below = F.substr("filepath", F.lit(len(folder.removeprefix("file:").rstrip("/")) + 2))
    return found.select(below.alias("filepath"), "kind", "size", "idx", "cnt", "offset", _sha("part").alias("sha256"))


@query
def scan_fragments(spark, sf_dir):
    """The same files as fragments, put together again: whole ones, and large ones by their pieces."""
    # Read once: several passes follow, and files are dearer to open than a table.
    rows = settle(rg.scan_fragments(spark, [_stored(spark, sf_dir)], 1000), "scanned")
    none = F.lit(None).cast("string")
    rows = rows.withColumns({"orig_checksum_type": none, "orig_checksum": none})
    whole = fr.reassemble(rows, ["filename", "identifier"], max_cell=5000)
    # A file above the cell has no content; its bytes are those of its ordered pieces.
    pieces = fr.ordered_pieces(rows.withColumn("orig_checksum_type", F.lit("SHA256")), ["filename", "identifier"])
    digests = pieces.filter("idx IS NULL").select("filename", F.col("digest").alias("sha256"))
    return whole.select("filename", "cnt", "size", "state", F.col("content").isNull().alias("large")).join(digests, "filename")


@query
def store_fragments(spark, sf_dir):
    """Fragments to files of any size on disk, and what stands there afterwards."""
    folder = shared_folder(spark, "received")
    sent = _fragments(spark, sf_dir).filter("NOT lost").withColumn("path", F.concat(F.lit("in/"), "path"))
    # Every 13th file was sent with a wrong checksum.
    wrong = F.when(F.expr("seq % 13 = 0"), F.sha2("orig_checksum", 256)).otherwise(F.col("orig_checksum"))
    told = settle(so.store_fragments(sent.withColumn("orig_checksum", wrong), folder), "told")
    there = rg.scan_fragments(spark, [folder], 1 << 20).select("filename", _sha("part").alias("sha256"))
    name = F.regexp_extract("filepath", r"([^/]*)$", 1)
    return told.select(name.alias("filename"), "state", "size").join(there, "filename", "left")


@query
def read_static_attrs(spark, sf_dir):
    return src.parse_static_attrs(v.table(spark, sf_dir, "pages"), "html", ["page_id"]).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def _staged(spark, sf_dir):
    folder = shared_folder(spark, "stage")
    named = literal_attrs({"path": F.col("path"), "filename": F.col("filename")})
    files = _files(spark, sf_dir).withColumn("attrs", named)
    st.stage_feed(files, folder, host="h1", at=F.lit(STAMP), batch_parts=8)
    return folder


@query
def stage_feed(spark, sf_dir):
    rows = st.read_staged(spark, _staged(spark, sf_dir))
    return rows.groupBy(
        "batch_id", get_attr(F.col("attrs"), "custodyChain.0.action").alias("action")
    ).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size").alias("bytes"),
        F.sum(get_attr(F.col("attrs"), "size").cast("bigint")).alias("attr_bytes"),
    )


@query
def committed_batches(spark, sf_dir):
    files = _files(spark, sf_dir)
    markers = files.filter("batch_id % 3 <> 0").select("batch_id").distinct()
    return st.committed_batches(files, markers).select("seq", "batch_id", "size")


def _marked_feed(spark, sf_dir):
    """A staged feed with what a replay must not see or see twice, files without a batch among it."""
    folder = shared_folder(spark, "stage")
    files = _files(spark, sf_dir).withColumn("attrs", literal_attrs({"path": F.col("path")}))
    # Every 50th batch is none: its files stand for themselves.
    files = files.withColumn("batch_id", F.when(F.expr("batch_id % 50 <> 0"), F.col("batch_id")))
    halves = [files.filter(f"coalesce(batch_id, 0) % 2 = {i}") for i in (0, 1)]
    for i, half in enumerate([*halves, halves[0]]):  # the first call is repeated
        st.stage_feed(half, folder, host="h1", at=F.lit(STAMP), batch_parts=8, call_id=f"half{i % 2}")
    orphan = settle(spark.read.parquet(f"{folder}/payload").withColumn("stage_id", F.lit("s-broken-off")), "orphan")
    orphan.write.mode("append").partitionBy("stage_id", "batch_part").parquet(f"{folder}/payload")
    return folder


@query
def replay_feed(spark, sf_dir):
    folder = _marked_feed(spark, sf_dir)
    writer = st.replay_into(spark, folder, f"{folder}/out", f"{folder}/replay", host="h2", at=F.lit(STAMP), max_files_per_trigger=1)
    writer.trigger(availableNow=True).start().awaitTermination()
    a = F.col("attrs")
    return spark.read.parquet(f"{folder}/out").select(
        "seq",
        "batch_id",
        "size",
        get_attr(a, "custodyChain.0.action").alias("action"),
        get_attr(a, "custodyChain.1.action").alias("earlier_action"),
        get_attr(a, "custodyChain.0.local.hostname").alias("host"),
        _sha("content").alias("sha256"),
    )


def _arriving(spark, files, name):
    """The files as a stream of four micro-batches, batches whole."""
    folder = shared_folder(spark, name)
    # A feed of any size comes in files of a bounded one, a quarter of them in each micro-batch.
    held = files.agg(F.sum("size")).first()[0] or 0
    # Files without a batch stand for themselves, so however many they are, they need not lie together.
    together = F.coalesce(F.col("batch_id"), F.monotonically_increasing_id())
    files.repartition(4 * (held // (4 * ARRIVING_BYTES) + 1), together).write.parquet(f"{folder}/in")
    count = len(spark.read.schema(files.schema).parquet(f"{folder}/in").inputFiles())
    stream = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", max(-(-count // 4), 1)).parquet(f"{folder}/in")
    return folder, stream


@query
def stage_stream(spark, sf_dir):
    """Staged as it arrives, and once more from the start: the same calls change nothing."""
    files = _files(spark, sf_dir).withColumn("attrs", literal_attrs({"path": F.col("path")}))
    folder, stream = _arriving(spark, files, "stage")
    for attempt in ("first", "again"):
        writer = st.stage_stream(stream, f"{folder}/staged", f"{folder}/{attempt}", host="h1", at=F.lit(STAMP), batch_parts=8)
        writer.trigger(availableNow=True).start().awaitTermination()
    rows = st.read_staged(spark, f"{folder}/staged")
    return rows.groupBy("batch_id", get_attr(F.col("attrs"), "custodyChain.0.action").alias("action")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )


@query
def relay_stream(spark, sf_dir):
    """Relayed as it arrives: each micro-batch is one marked write, split by outcome when it is read."""
    folder, stream = _arriving(spark, _relayed_files(spark, sf_dir), "relay")
    for attempt in ("first", "again"):
        writer = rl.relay_stream(
            stream, f"{folder}/relayed", f"{folder}/{attempt}", label="RELAY", remote="192.0.2.1:7", host="h1", pass_metrics=False, at=F.lit(STAMP)
        )
        writer.trigger(availableNow=True).start().awaitTermination()
    return _outcomes(*rl.read_relayed(spark, f"{folder}/relayed"))


@query
def on_complete(spark, sf_dir):
    """A hook that runs on every finished micro-batch: here it says what it was handed."""
    folder, stream = _arriving(spark, _files(spark, sf_dir).drop("content"), "hook")

    def note(rows, number):
        told = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
        told.write.mode("overwrite").parquet(f"{folder}/noted/number={number}")

    st.on_complete(stream, note, f"{folder}/state", available_now=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/noted").drop("number")


@query
def audit_feed(spark, sf_dir):
    return ck.audit_feed(_files(spark, sf_dir))


def _relayed_files(spark, sf_dir):
    kind = F.when(F.expr("seq % 41 = 0"), "metrics").otherwise("file")
    came = F.when(F.expr("seq % 2 = 0"), F.concat(F.lit("10.0.0."), F.col("seq").cast("string"))).otherwise("")
    return _files(spark, sf_dir).withColumns(
        {"kind": kind, "forwarded_for": came, "attrs": literal_attrs({"path": F.col("path")})}
    )


def _outcomes(out, rejects, metered):
    def told(rows, name):
        action = get_attr(F.col("attrs"), "custodyChain.0.action")
        return rows.select("seq", "forwarded_for", action.alias("action"), F.lit(name).alias("result"))

    return told(out, "out").unionByName(told(rejects, "reject")).unionByName(told(metered, "metrics"))


@query
def forward_feed(spark, sf_dir):
    files = _relayed_files(spark, sf_dir)
    return _outcomes(
        *flows.forward_feed(files, "RELAY", remote="192.0.2.1:7", host="h1", pass_metrics=False, at=F.lit(STAMP))
    )


@query
def outgoing_feed(spark, sf_dir):
    files = _files(spark, sf_dir).withColumn("attrs", literal_attrs({"path": F.col("path")}))
    sent = flows.outgoing_feed(files, 1000, host="h1", at=F.lit(STAMP))
    return sent.select(
        "seq",
        "kind",
        "target",
        "size",
        F.coalesce("fragment_index", F.lit(1)).alias("idx"),
        F.coalesce("fragment_count", F.lit(1)).alias("cnt"),
        get_attr(F.col("attrs"), "custodyChain.0.action").alias("action"),
        F.when(F.col("kind") == "file", F.col("checksum")).alias("checksum"),
    )



@query
def incoming_feed(spark, sf_dir):
    files = _odd_paths(spark, sf_dir).withColumn("kind", _odd_kind()).withColumn("target", _odd_target())
    return flows.incoming_feed(files, strict_filename=False).select("seq", "route", "clean_path", "state", "outcome")



@query
def synth_feed(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    made = sy.synth_feed(spark, 0, 0, 5000, ids=docs, size=F.expr("n_chars % 5000"), at=F.lit(STAMP))
    return made.select(
        "seq",
        "path",
        "filename",
        "size",
        "checksum_type",
        "checksum",
        F.octet_length("content").cast("bigint").alias("content_size"),
        get_attr(F.col("attrs"), "custodyChain.0.action").alias("action"),
    )



# Projections, filters, predicates


@query
def attach_static_attrs(spark, sf_dir):
    # The static table comes from the smallest table: one line per region, and one that repeats.
    regions = v.table(spark, sf_dir, "region")
    lines = regions.select(
        F.col("r_regionkey").cast("bigint").alias("pos"),
        F.concat(F.lit("area"), (F.col("r_regionkey") % 4).cast("string")).alias("name"),
        F.col("r_name").alias("value"),
    )
    own = literal_attrs({"area1": F.col("lang"), "source": F.col("source")})
    files = _files(spark, sf_dir).withColumn("attrs", own).select(F.col("seq").alias("uuid"), "attrs")
    return _pairs(cu.attach_static_attrs(files, lines))


@query
def shift_chain(spark, sf_dir):
    return _pairs(cu.shift_chain(_chains(spark, sf_dir), at=F.lit(STAMP)))


@query
def stamp_hop(spark, sf_dir):
    # Every third flow has no local host, which leaves that attribute out.
    local = F.when(F.expr("uuid % 3 = 0"), "").otherwise("::1")
    request = {
        "request_uri": "/in",
        "source_host": F.concat(F.lit("s"), (F.col("uuid") % 7).cast("string")),
        "source_port": "4000",
        "protocol": "HTTP",
        "local_host": local,
        "local_port": "8080",
    }
    chains = _chains(spark, sf_dir)
    stamped = cu.stamp_hop(chains, "RELAY", host="h1", request=request, static={"team": "a"}, at=F.lit(STAMP))
    return _pairs(stamped)


@query
def explode_hops(spark, sf_dir):
    hops = cu.explode_hops(_chains(spark, sf_dir))
    return hops.select("uuid", F.col("hop").cast("bigint").alias("hop"), "action", "hostname", "ts_ns")


@query
def append_forwarded_for(spark, sf_dir):
    pages = v.table(spark, sf_dir, "pages")
    earlier = F.when(F.expr("page_id % 3 = 0"), F.lit("")).when(F.expr("page_id % 3 = 1"), F.col("url"))
    rows = pages.select("page_id", earlier.alias("forwarded_for"))
    return cu.append_forwarded_for(rows, F.concat(F.lit("10.1."), (F.col("page_id") % 5).cast("string")))


@query
def add_checksum(spark, sf_dir):
    files = _files(spark, sf_dir)
    typed = files.withColumn("checksum_type", F.when(F.col("checksum").isNotNull(), F.lit("SHA256")))
    kept = ck.add_checksum(typed, "SHA1", only_if_missing=True).select(
        "seq", F.col("checksum_type").alias("kept_type"), F.col("checksum").alias("kept"), "content"
    )
    full = ck.add_checksum(kept, "SHA256").withColumnRenamed("checksum", "sha256")
    full = ck.add_checksum(full, "SHA1").withColumnRenamed("checksum", "sha1")
    return ck.add_checksum(full, "MD5").withColumnRenamed("checksum", "md5").select(
        "seq", "kept_type", "kept", "sha256", "sha1", "md5"
    )


@query
def verify_checksum(spark, sf_dir):
    files = _files(spark, sf_dir)
    # Every 29th row names a type that nobody knows.
    files = files.withColumn("checksum_type", F.when(F.expr("seq % 29 = 0"), "CRC99").otherwise(F.col("checksum_type")))
    strict = ck.verify_checksum(files, ck.STAGE)
    relay = ck.verify_checksum(strict.withColumnRenamed("accepted", "stage_ok"), ck.RELAY)
    audit = ck.verify_checksum(relay.withColumnRenamed("accepted", "relay_ok"), ck.AUDIT)
    return audit.select("seq", "state", "stage_ok", "relay_ok", F.col("accepted").alias("audit_ok"))


def _odd_paths(spark, sf_dir):
    """Paths of every shape the guard has to judge."""
    shape = F.expr(
        "CASE seq % 9 WHEN 0 THEN path WHEN 1 THEN 'a/../' || lang || '//' WHEN 2 THEN '../' || source "
        "WHEN 3 THEN '..' || source WHEN 4 THEN '/' || source || '/../' || lang "
        "WHEN 5 THEN source || '/../../' || lang WHEN 6 THEN '' WHEN 7 THEN '/../' || source || '/./' "
        "ELSE source || '/' || lang || '/../b/' END"
    )
    return _files(spark, sf_dir).withColumn("path", shape)


def _odd_kind():
    return F.expr(
        "CASE seq % 7 WHEN 0 THEN '' WHEN 1 THEN 'file' WHEN 2 THEN 'dir' WHEN 3 THEN 'link' "
        "WHEN 4 THEN 'metrics' WHEN 5 THEN 'pipe' END"
    )


def _odd_target():
    return F.expr(
        "CASE seq % 5 WHEN 0 THEN '../' || lang WHEN 1 THEN '../../../../' || lang WHEN 2 THEN '/etc/' || source "
        "WHEN 3 THEN '' ELSE 'x/./y/../' || filename END"
    )


@query
def path_guard(spark, sf_dir):
    ok, rejects = gd.path_guard(_odd_paths(spark, sf_dir), strict_filename=False)
    return ok.unionByName(rejects).select("seq", "path", "clean_path", "path_ok")


@query
def link_guard(spark, sf_dir):
    links = _files(spark, sf_dir).withColumn("target", _odd_target())
    ok, dropped = gd.link_guard(links)
    return ok.unionByName(dropped).select("seq", "target", "resolved", "link_ok")


@query
def route_by_kind(spark, sf_dir):
    routed = gd.with_route(_files(spark, sf_dir).withColumn("kind", _odd_kind()))
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


@query
def parse_frames(spark, sf_dir):
    frames = fm.parse_frames(v.feed_datagrams(_frames(spark, sf_dir)))
    return frames.select(
        "seq",
        "pass",
        "uuid",
        "size",
        "offset",
        F.col("mtu").cast("bigint").alias("mtu"),
        _sha("payload").alias("payload_sha"),
    )


@query
def frame_faults(spark, sf_dir):
    return fm.frame_faults(v.feed_datagrams(_frames(spark, sf_dir)))


@query
def canonical_attrs(spark, sf_dir):
    files = _files(spark, sf_dir)
    odd = F.expr("seq % 2 = 1")
    attrs = literal_attrs(
        {
            "checksum-type": F.when(odd | F.expr("seq % 3 = 0"), "OLD"),
            "checksumType": F.when(~odd, "NEW"),
            "modtime": F.when(odd, F.col("source")),
            "lang": F.col("lang"),
        }
    )
    return _pairs(model.canonical_attrs(files.select(F.col("seq").alias("uuid"), attrs.alias("attrs"))))



@query
def attrs_json(spark, sf_dir):
    from_json, to_json = at.attrs_from_json, at.attrs_to_json
    return _pairs(_chains(spark, sf_dir).withColumn("attrs", from_json(to_json(F.col("attrs")))))


@query
def numbered_packets(spark, sf_dir):
    talks = v.table(spark, sf_dir, "conversations").select(
        F.expr("CASE WHEN conv_id % 9 = 0 THEN '' ELSE cast(conv_id AS string) END").alias("socket_id"),
        F.expr("CASE WHEN turn % 5 = 4 THEN 'x' || turn ELSE cast(turn + 1 AS string) END").alias("n"),
    )
    ok, rejects = sq.numbered_packets(talks)
    told = ok.withColumns({"n": F.col("n").cast("string"), "accepted": F.lit(True)})
    return told.unionByName(rejects.withColumn("accepted", F.lit(False)))


# Joins


@query
def resolve_links(spark, sf_dir):
    deduped = settle(dd.dedup_to_links(_hashed(_files(spark, sf_dir))), "deduped")
    links = deduped.filter("kind = 'link'")
    kept = deduped.filter("kind <> 'link'")
    # Every 10th link points to a file that is not there.
    links = links.withColumn("target", F.when(F.expr("seq % 10 = 0"), "gone.txt").otherwise(F.col("target")))
    found = dd.resolve_links(kept, links, restore=("size", "checksum"))
    return found.select("seq", "resolved", "link_state", "resolved_size", "resolved_checksum")


@query
def missing_fragments(spark, sf_dir):
    return fr.missing_fragments(_fragments(spark, sf_dir).filter("NOT lost"))


# Aggregations


@query
def fragment_status(spark, sf_dir):
    return fr.fragment_status(_fragments(spark, sf_dir).filter("NOT lost"))


def _days(spark, sf_dir):
    """Bitmaps of two days' fragments, each day read and stored by itself, and merged."""
    sent = _fragments(spark, sf_dir).filter("NOT lost").drop("part")
    days = [settle(bm.piece_bitmaps(sent.filter(f"(seq + idx) % 3 {test} 0")), "day") for test in ("=", "<>")]
    return bm.merge_bitmaps(*days)


@query
def bitmap_status(spark, sf_dir):
    return bm.bitmap_status(_days(spark, sf_dir))


@query
def bitmap_gaps(spark, sf_dir):
    return bm.bitmap_gaps(_days(spark, sf_dir))


@query
def reassemble(spark, sf_dir):
    whole = fr.reassemble(_fragments(spark, sf_dir).filter("NOT lost"))
    return whole.select("identifier", "cnt", "size", "state", _sha("content").alias("sha256"))


@query
def frame_status(spark, sf_dir):
    return fm.frame_status(_frames(spark, sf_dir))


@query
def reassemble_frames(spark, sf_dir):
    expected = _files(spark, sf_dir).withColumn("uuid", F.col("seq").cast("string"))
    whole = fm.reassemble_frames(_frames(spark, sf_dir), expected)
    return whole.select("uuid", "size", "assembly", "state", "accepted", _sha("content").alias("sha256"))


@query
def batch_gate(spark, sf_dir):
    judged = ck.verify_checksum(_files(spark, sf_dir), ck.STAGE)
    judged = settle(judged.drop("content"), "verdicts")
    ok, rejects = ck.batch_gate(judged)
    return ok.unionByName(rejects).select("seq", "batch_id", "state", "batch_ok")


@query
def size_histogram(spark, sf_dir):
    rows = mt.size_histogram(v.feed_metrics_rows(_hops(spark, sf_dir)))
    return rows.withColumn("bucket", F.col("bucket").cast("bigint"))


@query
def feed_metrics(spark, sf_dir):
    rows = mt.feed_metrics(v.feed_metrics_rows(_hops(spark, sf_dir)))
    return rows.withColumn("period_start", F.unix_seconds("period_start"))


@query
def custody_paths(spark, sf_dir):
    return cu.custody_paths(_hops(spark, sf_dir))


@query
def custody_paths_from_attrs(spark, sf_dir):
    chains = _chains(spark, sf_dir)
    return chains.groupBy(cu.custody_path(F.col("attrs")).alias("path")).agg(F.count(F.lit(1)).alias("files"))


@query
def dedup_savings(spark, sf_dir):
    return dd.dedup_savings(dd.dedup_to_links(_hashed(_files(spark, sf_dir))))


# Ordered operators


@query
def dedup_to_links(spark, sf_dir):
    deduped = dd.dedup_to_links(_hashed(_files(spark, sf_dir)))
    return deduped.select("seq", "filepath", "kind", "target", "size", "orig_size", "checksum")


@query
def hop_latency(spark, sf_dir):
    return cu.hop_latency(_hops(spark, sf_dir)).withColumn("sum", F.col("sum").cast("bigint"))


@query
def hop_latency_from_attrs(spark, sf_dir):
    rows = cu.latency_of_pairs(cu.attr_hop_pairs(_chains(spark, sf_dir)))
    return rows.withColumn("sum", F.col("sum").cast("bigint"))


@query
def latest_attempt(spark, sf_dir):
    current = fr.latest_attempt(v.feed_attempts(_fragments(spark, sf_dir)))
    return fr.fragment_status(current, ["path", "filename", "identifier"])


@query
def inflight_runs(spark, sf_dir):
    """What each run holds and how it ended, from the frames that the operator has marked."""
    told = fm.with_slots(fm.inflight_runs(_frames(spark, sf_dir)))
    length = F.octet_length("payload").alias("length")
    told = settle(told.select("port", "uuid", "arrival", "run_start", "followed", "total", "slot", "carries", length), "marked")
    run = ["port", "uuid", "run_start"]
    held = told.groupBy(*run, "followed").agg(F.count(F.lit(1)).alias("frames"), F.sum("length").alias("bytes"))
    # A run of frames that no slot can be told of has no status, and stays.
    rows = join_null_safe(held, fm.judged_runs(told).drop("followed").hint("merge"), run, "left")
    return rows.withColumn("port", F.col("port").cast("bigint"))


@query
def run_status(spark, sf_dir):
    rows = fm.run_status(_frames(spark, sf_dir))
    return rows.withColumn("port", F.col("port").cast("bigint"))


@query
def sequence_release(spark, sf_dir):
    released = sq.sequence_release(_packets(spark, sf_dir))
    return released.select("socket_id", "n", "op", "arrival", "released_at", _sha("payload").alias("sha256"))


@query
def sequence_gaps(spark, sf_dir):
    return sq.sequence_gaps(_packets(spark, sf_dir))


# Sorts, set operations, segmentation


@query
def walk_order(spark, sf_dir):
    files = _files(spark, sf_dir).select(
        (F.col("seq") % 2).alias("arg_pos"),
        # Some directories differ in a character that sorts before the slash.
        F.concat(F.lit("src/"), "source", F.when(F.expr("seq % 3 = 0"), "-b/").otherwise("/"), "filename").alias("filepath"),
        "size",
    )
    return src.number_in_walk_order(files)


@query
def merge_metrics(spark, sf_dir):
    rows = v.feed_metrics_rows(_hops(spark, sf_dir))
    local = rows.filter("uuid % 2 = 0")
    upstream = rows.filter("uuid % 2 = 1")
    report, forwarded = mt.merge_metrics(local, upstream)
    sent = mt.feed_metrics(forwarded).select(
        "period_start", "host", "action", F.col("files").alias("forwarded_files")
    )
    merged = report.join(sent, ["period_start", "host", "action"], "left")
    return merged.withColumn("period_start", F.unix_seconds("period_start")).withColumn(
        "forwarded_files", F.coalesce("forwarded_files", F.lit(0))
    )


@query
def segment(spark, sf_dir):
    pieces = fr.segment(ck.add_checksum(_files(spark, sf_dir)), 1000)
    return pieces.select(
        "seq",
        F.col("fragment_index").alias("idx"),
        F.col("fragment_count").alias("cnt"),
        F.col("fragment_offset").alias("off"),
        "size",
        "checksum",
        "orig_size",
        "orig_checksum",
    )


# Streams: each runs over its whole table and returns what it wrote


def _run(spark, stream, name):
    folder = shared_folder(spark, name)
    sf.run_available(stream, folder)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@query
def stream_fragments(spark, sf_dir):
    files = v.feed_files(v.table_stream(spark, sf_dir, "documents"))
    attempts = v.feed_attempts(v.feed_fragments(files))
    # Every 40th piece has lost its number; what is unfinished is given up after five seconds.
    attempts = attempts.withColumn("idx", F.when(F.expr("(seq + idx) % 40 <> 0"), F.col("idx")))
    out = _run(spark, sf.stream_fragments(attempts, ttl_ms=5000), "fragments")
    return out.select("path", "filename", "identifier", "event", "seen", "cnt")


@query
def stream_frames(spark, sf_dir):
    files = v.feed_files(v.table_stream(spark, sf_dir, "documents"))
    out = _run(spark, sf.stream_frames(v.feed_frames(files).filter("NOT lost")), "frames")
    return out.select(F.col("port").cast("bigint").alias("port"), "uuid", "event", "total", "seen")


@query
def stream_sequence(spark, sf_dir):
    last = v.last_turns(v.table(spark, sf_dir, "conversations"))
    talks = v.table_stream(spark, sf_dir, "conversations")
    packets = v.feed_packets(talks, last).filter("NOT lost")
    packets = packets.withColumn("arrived_at", v.arrival_time(F.col("n")))
    out = _run(spark, sf.stream_sequence(packets), "packets")
    return out.select("socket_id", "n", "event", F.col("used").alias("arrival"))


@query
def stream_dedup(spark, sf_dir):
    files = ck.add_checksum(v.feed_files(v.table_stream(spark, sf_dir, "documents")))
    files = files.withColumn("arrived_at", v.arrival_time(F.lit(0)))
    return _run(spark, sf.stream_dedup(files), "dedup")


@query
def stream_metrics(spark, sf_dir):
    rows = v.feed_metrics_rows(v.feed_hops(v.table_stream(spark, sf_dir, "events")))
    out = _run(spark, sf.stream_metrics(rows), "metrics")
    return out.withColumn("period_start", F.unix_seconds("period_start"))
