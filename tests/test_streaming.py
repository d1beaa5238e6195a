"""A stream fed file by file, with a restart midway, must equal the batch operator."""

import os
import random

import pytest
from pyspark.sql import functions as F

from feedkit.operators.dedup import dedup_to_links
from feedkit.operators.fragments import fragment_status, latest_attempt
from feedkit.operators.frames import run_status
from feedkit.operators.metrics import feed_metrics
from feedkit.operators.sequence import sequence_release
from feedkit.streaming import feeds as sf
from helpers import tuples

DAY = sf.DAY_MS
START = 1_700_000_000


class Feed:
    """A folder that files arrive in, and the query that reads it one file per trigger."""

    def __init__(self, spark, folder, schema, operator):
        self.spark, self.folder, self.schema, self.operator = spark, str(folder), schema, operator
        self.source = f"{folder}/in"
        self.files = 0

    def arrive(self, rows):
        self.files += 1
        part = f"{self.folder}/part{self.files}"
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.makedirs(self.source, exist_ok=True)
        target = f"{self.source}/{self.files:04d}.parquet"
        os.link(f"{part}/{name}", target)
        os.utime(target, (START + self.files, START + self.files))

    def run(self):
        schema = self.spark.createDataFrame([], self.schema).schema
        stream = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.source)
        with_time = stream.withColumn("arrived_at", F.timestamp_seconds("second")).drop("second")
        sf.run_available(self.operator(with_time), self.folder)
        return self.spark.read.parquet(f"{self.folder}/out")


def pieces(rows, n):
    step = -(-len(rows) // n)
    return [rows[i : i + step] for i in range(0, len(rows), step)]


def test_fragments(spark, tmp_path):
    rng, rows = random.Random(5), []
    for p in range(20):
        sent = [(f"p{p}", "f", "A", i, 5) for i in range(1, rng.randint(1, 5))]
        last = [(f"p{p}", "f", "B", i, 5) for i in range(1, 6) if p % 3 or i != 4]
        rng.shuffle(last)
        rows += [(rng.random() + (ident == "B"), *r, ident) for ident, part in (("A", sent), ("B", last + last[:2])) for r in part]
    rows = [(*r[1:6], at, START + at) for at, r in enumerate(sorted(rows))]
    schema = "path string, filename string, identifier string, idx bigint, cnt bigint, arrival bigint, second bigint"
    feed = Feed(spark, tmp_path, schema, lambda s: sf.stream_fragments(s, ttl_ms=DAY))
    for part in pieces(rows, 4)[:2]:
        feed.arrive(part)
    feed.run()
    for part in pieces(rows, 4)[2:]:
        feed.arrive(part)
    # One row a week later moves the watermark past everything that is still open.
    feed.arrive([("z", "f", "Z", 1, 2, 10**6, START + 7 * 86400), ("huge", "f", "H", 1, 10**15, 10**6, START + 7 * 86400)])
    out = feed.run()
    assert tuples(out.filter("event = 'refused'"), "path", "cnt") == [("huge", 10**15)]
    batch = fragment_status(latest_attempt(spark.createDataFrame(rows, schema)), ["path", "identifier"])
    assert tuples(out.filter("event = 'completed'"), "path", "identifier") == tuples(
        batch.filter("state = 'complete'"), "path", "identifier"
    )
    assert tuples(out.filter("event = 'expired'"), "path", "identifier", "seen") == tuples(
        batch.filter("state = 'incomplete'"), "path", "identifier", "seen"
    )


@pytest.mark.parametrize("key", ["port", "uuid"])
def test_frames(spark, tmp_path, key):
    rng, rows, at = random.Random(9), [], 0
    for port in range(4):
        for f in range(6):
            total = rng.randint(1, 4)
            slots = [s for s in range(total) for _ in range(2) if rng.random() < 0.85]
            for s in slots or [0]:
                at += 1
                rows.append((port, at, f"{port}-{f}", total * 100, s * 100, 100, START + at))
    schema = "port int, arrival bigint, uuid string, size bigint, offset bigint, mtu int, second bigint"
    feed = Feed(spark, tmp_path, schema, lambda s: sf.stream_frames(s, ttl_ms=DAY, key=key))
    for i, part in enumerate(pieces(rows, 4)):
        feed.arrive(part)
        if i == 1:
            feed.run()
    feed.arrive([(99, 10**6, "z", 200, 0, 100, START + 7 * 86400)])
    out = feed.run()
    batch = run_status(spark.createDataFrame(rows, schema))
    assert tuples(out.filter("event = 'completed'"), "port", "uuid", "total") == tuples(
        batch.filter("state = 'complete'"), "port", "uuid", "total"
    )
    unfinished = tuples(batch.filter("state <> 'complete'"), "port", "uuid", "seen")
    assert tuples(out.filter("event IN ('abandoned', 'expired')"), "port", "uuid", "seen") == unfinished
    events = {r["event"] for r in out.collect()}
    assert ("abandoned" in events) == (key == "port")


def test_sequence(spark, tmp_path):
    rng, rows = random.Random(11), []
    for s in range(25):
        count = rng.randint(1, 8)
        numbers = [n for n in range(1, count + 1) for _ in range(rng.choice([0, 1, 1, 1, 2]))]
        rng.shuffle(numbers)
        rows += [(f"s{s}", n, "EOF" if n == count else "") for n in numbers]
    rng.shuffle(rows)
    rows = [(*r, at, START + at) for at, r in enumerate(rows)]
    schema = "socket_id string, n bigint, op string, arrival bigint, second bigint"
    feed = Feed(spark, tmp_path, schema, lambda s: sf.stream_sequence(s, ttl_ms=DAY))
    for i, part in enumerate(pieces(rows, 5)):
        feed.arrive(part)
        if i == 2:
            feed.run()
    feed.arrive([("z", 1, "EOF", 10**6, START + 7 * 86400)])
    out = feed.run()
    batch = sequence_release(spark.createDataFrame(rows, schema))
    got = tuples(out.filter("event = 'released' AND socket_id <> 'z'").withColumn("a", F.col("used").cast("bigint")), "socket_id", "n", "a")
    assert got == tuples(batch, "socket_id", "n", "arrival")
    closed = {r["socket_id"] for r in batch.filter("op = 'EOF'").collect()}
    assert {r["socket_id"] for r in out.filter("event = 'expired'").collect()} == {r[0] for r in rows} - closed


def test_dedup(spark, tmp_path):
    rng = random.Random(13)
    rows = [
        (i, rng.choice(["d", "d/e"]), f"f{i}", rng.choice([0, 5]), "S", rng.choice(["a", "b", "c", None]), START + i)
        for i in range(60)
    ]
    schema = "seq bigint, path string, filename string, size bigint, checksum_type string, checksum string, second bigint"
    feed = Feed(spark, tmp_path, schema, lambda s: sf.stream_dedup(s, ttl_ms=DAY))
    for i, part in enumerate(pieces(rows, 4)):
        feed.arrive(part)
        if i == 1:
            feed.run()
    out = feed.run()
    batch = dedup_to_links(spark.createDataFrame(rows, schema))
    assert tuples(out, "seq", "filepath", "kind", "target") == tuples(batch, "seq", "filepath", "kind", "target")
    # After the time-out the content counts as new.
    feed.arrive([(100, "d", "g", 5, "S", "a", START + 3 * 86400)])
    feed.run()
    feed.arrive([(101, "d", "h", 5, "S", "a", START + 9 * 86400)])
    feed.run()
    feed.arrive([(102, "d", "i", 5, "S", "a", START + 9 * 86400 + 1)])
    late = {r["seq"]: r["target"] for r in feed.run().filter("seq > 100").collect()}
    assert late[102] is not None


def test_metrics(spark, tmp_path):
    rng = random.Random(17)
    rows = [("h", rng.choice("AB"), START + 37 * i, rng.randint(0, 99), 1) for i in range(80)]
    schema = "host string, action string, second bigint, size bigint, files bigint"
    feed = Feed(
        spark, tmp_path, schema,
        lambda s: sf.stream_metrics(s.withColumnRenamed("arrived_at", "ts"), delay="1 minute"),
    )
    for part in pieces(rows, 4):
        feed.arrive(part)
    out = feed.run()
    batch = feed_metrics(spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("second")))
    closed = batch.filter(F.unix_seconds("period_start") + 300 <= START + 37 * 79 - 60)
    assert tuples(out, "period_start", "action", "files", "bytes") == tuples(
        closed, "period_start", "action", "files", "bytes"
    )
