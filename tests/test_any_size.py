"""Files of any size: byte ranges, ordered folds, and files on disk."""

from __future__ import annotations

import hashlib
import os
import random

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from feedkit.operators import fragments as fr
from feedkit.operators.fragments import segment
from feedkit.plans import folding
from feedkit.sources import ranges, store

FRAGMENTS = (
    "identifier string, path string, filename string, idx bigint, cnt bigint, offset bigint, part binary, orig_size bigint, "
    "orig_checksum_type string, orig_checksum string, arrival bigint"
)


def test_a_sparse_file_of_three_gib_comes_out_in_ranges(spark, tmp_path):
    size = 3 << 30
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(size)
        f.seek(size - 5)
        f.write(b"ended")
    rows = ranges.scan_ranges(spark, [str(tmp_path)])
    told = rows.select("idx", "cnt", "size", F.octet_length("part").alias("n"), F.substring(F.col("part"), -5, 5).alias("end")).collect()
    assert len(told) == 48 and {(r["cnt"], r["size"]) for r in told} == {(48, size)}
    assert max(r["n"] for r in told) == ranges.RANGE_BYTES and sum(r["n"] for r in told) == size
    assert bytes(max(told, key=lambda r: r["idx"])["end"]) == b"ended"
    assert rows.rdd.getNumPartitions() >= size // ranges.TASK_BYTES  # its parts are read side by side


def test_empty_files_and_folders_are_listed(spark, tmp_path):
    for name, data in (("a/one", b"12345"), ("a/none", b""), ("b-c/two", b"ab"), ("ä ö/%41", b"z")):
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_bytes(data)
    os.makedirs(tmp_path / "empty/inner")
    rows = ranges.scan_ranges(spark, [str(tmp_path), str(tmp_path / "a/one")], 2)
    at = len(str(tmp_path)) + 2
    got = tuples(rows.withColumn("name", F.substr("filepath", F.lit(at))), "arg_pos", "name", "kind", "size", "idx", "cnt", "offset", "part")
    want = [(p, "a/one", "file", 5, i + 1, 3, 2 * i, b"12345"[2 * i : 2 * i + 2]) for p in (0, 1) for i in range(3)]
    want += [(0, "a/none", "file", 0, 1, 1, 0, b""), (0, "b-c/two", "file", 2, 1, 1, 0, b"ab"), (0, "ä ö/%41", "file", 1, 1, 1, 0, b"z"), (0, "empty/inner", "dir", 0, 1, 1, 0, None)]
    assert got == sorted(want, key=repr)
    unread = ranges.scan_ranges(spark, [str(tmp_path)], 2, content=False)
    assert unread.filter("part IS NOT NULL").count() == 0 and unread.count() == 7
    with pytest.raises(Exception, match="nothere"):
        ranges.scan_ranges(spark, [str(tmp_path / "nothere")]).count()
    with pytest.raises(Exception, match="at least 1"):
        ranges.scan_ranges(spark, [str(tmp_path)], 0).count()


def test_a_file_that_shrank_ends_the_job(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"123456")
    reader = ranges.RangeReader({"paths": f'["{tmp_path}"]', "range_bytes": "4"})
    parts = reader.partitions()
    (tmp_path / "f").write_bytes(b"123")
    with pytest.raises(OSError, match="shorter"):
        list(reader.read(parts[0]))


def odd_fragments():
    """Complete, short, torn, stray, repeated, unsupported and unnamed files."""
    choice = random.Random(7)
    rows = []

    def send(ident, body, step=4, kind="SHA256", check=None, size=None, skip=(), change=None, late=()):
        cnt = -(-len(body) // step)
        check = hashlib.sha256(body).hexdigest() if check is None else check
        for i in range(cnt):
            part = body[i * step : (i + 1) * step]
            part = change(i, part) if change else part
            if i + 1 not in skip:
                rows.append((ident, "p", f"f{ident}", i + 1, cnt, i * step, part, len(body) if size is None else size, kind, check, choice.randint(100, 200)))
        rows.extend(late)

    send("whole", b"abcdefghij")
    send("md", b"abcdefghij", kind="md5", check=hashlib.md5(b"abcdefghij").hexdigest())
    send("lost", b"abcdefghij", skip=(2,))
    send("torn", b"abcdefghij", change=lambda i, p: b"XX" + p[2:] if i == 1 else p)
    send("plain", b"abcdefghij", kind=None, check="")
    send("short", b"abcdefghij", check="", change=lambda i, p: p[:2] if i == 1 else p)
    send("nopart", b"abcdefghij", check="", change=lambda i, p: None if i == 0 else p)
    send("kind", b"abcdefghij", kind="CRC99")
    send("strays", b"abcdefghij", late=[("strays", "p", "fstrays", i, 9, 0, b"??", 99, "SHA256", "no", 900 + i) for i in (1, 5, 9)])
    send("copies", b"abcdefghij", late=[("copies", "p", "fcopies", 2, 3, 4, b"late", 10, "SHA256", "no", 999), ("copies", "p", "fcopies", 3, 3, 8, b"??", 10, "SHA256", "no", None)])
    send(None, b"abcdefghij")
    return rows


WANTED = {
    "whole": "complete", "md": "complete", "torn": "corrupt", "plain": "unverified", "short": "corrupt",
    "nopart": "corrupt", "kind": "corrupt", "strays": "complete", "copies": "complete", None: "complete",
}


@pytest.mark.parametrize("cell", [1 << 30, 9, 0])
def test_verdicts_do_not_depend_on_the_cell(spark, cell):
    df = spark.createDataFrame(odd_fragments(), FRAGMENTS).repartition(3)
    got = {r["identifier"]: r for r in fr.reassemble(df, max_cell=cell).collect()}
    assert {k: r["state"] for k, r in got.items()} == WANTED
    for r in got.values():
        sound = r["state"] in ("complete", "unverified")
        assert (None if r["content"] is None else bytes(r["content"])) == (b"abcdefghij" if sound and cell > 9 else None)
        assert not sound or r["size"] == 10
    status = {r["identifier"]: (r["seen"], r["cnt"], r["state"]) for r in fr.fragment_status(df).collect()}
    assert status["strays"] == (3, 3, "complete") and status["lost"] == (2, 3, "incomplete")
    assert tuples(fr.missing_fragments(df), "identifier", "idx") == [("lost", 2)]


@pytest.mark.parametrize("batch", ["1", "10000"])
def test_ordered_pieces_come_in_order_with_one_verdict(spark, batch):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = fr.ordered_pieces(spark.createDataFrame(odd_fragments(), FRAGMENTS).repartition(4)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    files, open_file, positions, data = {}, object(), [], b""
    for r in rows:  # a file's rows follow one another
        if r["state"] is None:
            assert not positions or r["identifier"] == open_file
            open_file = r["identifier"]
            positions.append(r["idx"])
            data += bytes(r["part"] or b"")
        else:
            assert positions == sorted(set(positions)) and r["size"] == len(data)
            files[r["identifier"]] = (r["state"], data)
            positions, data = [], b""
    assert {k: s for k, (s, _) in files.items()} == {**WANTED, "lost": "incomplete"}
    assert all(data == b"abcdefghij" for s, data in files.values() if s in ("complete", "unverified"))


def test_fold_holds_one_batch(spark, monkeypatch):
    """However many pieces a file has, a running digest and a batch are what a task keeps."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.lit("f").alias("identifier"), (F.col("id") + 1).alias("idx"), F.lit(40_000).cast("bigint").alias("cnt"),
        F.expr("cast(repeat('x', 100) as binary)").alias("part"), F.lit(4_000_000).cast("bigint").alias("orig_size"),
        F.lit("SHA1").alias("orig_checksum_type"), F.lit(hashlib.sha1(b"x" * 4_000_000).hexdigest()).alias("orig_checksum"), F.col("id").alias("arrival"),
    )
    got = fr.reassemble(rows, max_cell=1000).first()
    assert (got["state"], got["size"], got["content"]) == ("complete", 4_000_000, None)
    fold = folding.Fold("SHA-256")
    assert fold.hash is not None and folding.Fold("CRC").digest() is None


def test_store_writes_whole_files_only(spark, tmp_path):
    folder = tmp_path / "out"
    df = spark.createDataFrame([r for r in odd_fragments() if r[0] is not None], FRAGMENTS)
    bad = spark.createDataFrame([("up", "../..", "x", i, 2, i - 1, b"z", 2, "", "", i) for i in (1, 2)], FRAGMENTS)
    told = store.store_fragments(df.unionByName(bad), str(folder)).collect()
    states = {os.path.basename(r["filepath"])[1:]: r["state"] for r in told if r["state"] != "refused"}
    assert states == {**{k: s for k, s in WANTED.items() if k}, "lost": "incomplete"}
    assert [r["filepath"] for r in told if r["state"] == "refused"] == ["../../x"]
    there = sorted(os.listdir(folder / "p"))
    assert there == sorted(f"f{k}" for k, s in WANTED.items() if k and s in store.ACCEPTED)
    assert {(folder / "p" / n).read_bytes() for n in there} == {b"abcdefghij"}
    again = store.store_fragments(df, str(folder)).count()  # the same files once more
    assert again == len(states) and sorted(os.listdir(folder / "p")) == there


def test_disk_to_segments_to_disk(spark, tmp_path):
    """What a folder holds comes out of its fragments as it was."""
    choice = random.Random(11)
    for i in range(30):
        (tmp_path / f"in{i % 3}").mkdir(exist_ok=True)
        (tmp_path / f"in{i % 3}" / f"f{i}").write_bytes(choice.randbytes(choice.choice([0, 1, 10, 99, 100, 101, 1000])))
    rows = ranges.scan_fragments(spark, [str(tmp_path)], 100).withColumns(
        {"orig_checksum_type": F.lit(None).cast("string"), "orig_checksum": F.lit(None).cast("string"), "path": F.substr("path", F.lit(len(str(tmp_path)) + 2))}
    )
    told = store.store_fragments(rows.filter("cnt > 1"), str(tmp_path / "out")).collect()
    files = rows.filter("cnt = 1").withColumn("content", F.col("part"))
    told += store.store_files(files, str(tmp_path / "out")).collect()
    assert len(told) == 30 and {r["state"] for r in told} <= {"unverified", "stored"}
    for i in range(30):
        name = f"in{i % 3}/f{i}"
        assert (tmp_path / "out" / name).read_bytes() == (tmp_path / name).read_bytes()


def test_segment_of_rows_without_content_keeps_sizes(spark):
    files = spark.createDataFrame([(1, "f", 250, None, None, None)], "seq bigint, filename string, size bigint, content binary, checksum_type string, checksum string")
    assert tuples(segment(files, 100), "fragment_index", "size", "content") == [(1, 100, None), (2, 100, None), (3, 50, None)]
