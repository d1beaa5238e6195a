"""Worked examples with known results."""

import pytest
from pyspark.sql import functions as F

from feedkit.functions.attributes import attrs_from_json, attrs_to_json, nanos
from feedkit.functions.paths import dirname, rel
from feedkit.model import canonical_attrs
from feedkit.operators.custody import (
    append_forwarded_for,
    attach_static_attrs,
    custody_path,
    explode_hops,
    hop_latency,
    hop_pairs,
    shift_chain,
    stamp_hop,
)
from feedkit.operators.fragments import segment, smaller_limit
from feedkit.operators.guards import mark_links, mark_paths
from feedkit.sources.files import number_in_walk_order, read_static_attrs, scan_files
from helpers import tuples

LINES = """# a comment: with a colon
owner:\t ann\x20\x20
port: 123
team:   Blue
a line of words alone
url: http://h:1/x
owner: bob
"""

# Names and times of two published custody chains, to the nanosecond.
WHOLE = [
    (3, "SENDER", "2023-02-27T21:19:33.073776445-05:00"),
    (2, "HTTP-TO-UDP", "2023-02-27T21:19:37.86005549-05:00"),
    (1, "UDP-TO-HTTP", "2023-02-27T21:19:38.008201823-05:00"),
    (0, "DIODE", "2023-02-27T21:19:38.009837137-05:00"),
]
PIECE = [
    (3, "SENDER", "2023-02-27T21:30:52.285694345-05:00"),
    (2, "HTTP-TO-UDP", "2023-02-27T21:31:04.139123244-05:00"),
    (1, "UDP-TO-HTTP", "2023-02-27T21:31:04.68476102-05:00"),
    (0, "DIODE", "2023-02-27T21:31:04.685546823-05:00"),
]


def chain_of(hops):
    attrs = {}
    for n, action, time in hops:
        attrs[f"custodyChain.{n}.action"] = action
        attrs[f"custodyChain.{n}.time"] = time
    return attrs


def test_static_attribute_lines(spark, tmp_path):
    file = tmp_path / "attrs.yml"
    file.write_text(LINES)
    rows = read_static_attrs(spark, str(file))
    assert tuples(rows, "pos", "name", "value") == [
        (1, "owner", "ann"),
        (2, "port", "123"),
        (3, "team", "Blue"),
        (5, "url", "http://h:1/x"),
        (6, "owner", "bob"),
    ]
    files = spark.createDataFrame([({"team": "old", "x": "1"},)], "attrs map<string,string>")
    got = attach_static_attrs(files, rows).first()["attrs"]
    assert got == {"owner": "bob", "port": "123", "team": "Blue", "url": "http://h:1/x", "x": "1"}


@pytest.mark.parametrize(
    ("hops", "gaps"),
    [
        (WHOLE, {"SENDER": 4786279045, "HTTP-TO-UDP": 148146333, "UDP-TO-HTTP": 1635314}),
        (PIECE, {"SENDER": 11853428899, "HTTP-TO-UDP": 545637776, "UDP-TO-HTTP": 785803}),
    ],
)
def test_hop_latency_to_the_nanosecond(spark, hops, gaps):
    files = spark.createDataFrame([("u", chain_of(hops))], "uuid string, attrs map<string,string>")
    exploded = explode_hops(files)
    assert tuples(exploded, "hop", "action") == sorted((n, a) for n, a, _ in hops)
    got = {r["from_action"]: r["elapsed"] for r in hop_pairs(exploded).collect()}
    assert got == gaps
    stats = hop_latency(exploded).collect()
    assert {r["from_action"]: (r["n"], r["sum"], r["p50"], r["p95"], r["max"]) for r in stats} == {
        k: (1, g, g, g, g) for k, g in gaps.items()
    }
    assert files.select(custody_path(F.col("attrs"))).first()[0] == "SENDER>HTTP-TO-UDP>UDP-TO-HTTP>DIODE"


def test_nanos_edges(spark):
    rows = [
        ("1970-01-01T00:00:00Z", 0),
        ("1970-01-01T00:00:00.5Z", 500_000_000),
        ("1970-01-01T01:00:00.000000001+01:00", 1),
        ("yesterday", None),
        ("1970-01-01T00:00:00.1234567890Z", None),
    ]
    df = spark.createDataFrame(rows, "t string, want bigint")
    assert all(r["got"] == r["want"] for r in df.withColumn("got", nanos(F.col("t"))).collect())


PATHS = [
    ("", ".", True),
    ("./", ".", True),
    ("output2/", "output2", True),
    ("a/./b/../c//", "a/c", True),
    ("a/../..", "..", False),
    ("../x", "../x", False),
    ("..foo", "..foo", False),
    ("/abs/../x", "/x", True),
    ("/../x", "/x", True),
]


def test_path_guard(spark):
    df = spark.createDataFrame([(p, "f") for p, _, _ in PATHS], "path string, filename string")
    assert tuples(mark_paths(df), "path", "clean_path", "path_ok") == sorted(PATHS, key=repr)


def test_strict_filename(spark):
    df = spark.createDataFrame([("a", "../x"), ("a", ".."), ("a", "x")], "path string, filename string")
    assert tuples(mark_paths(df), "filename", "path_ok") == [("..", False), ("../x", False), ("x", True)]
    loose = mark_paths(df, strict_filename=False)
    assert {r["path_ok"] for r in loose.collect()} == {True}


def test_link_guard(spark):
    rows = [("a/b", "../c", True), ("a", "../../c", False), ("a", "/etc/x", False), ("a", "", False)]
    df = spark.createDataFrame([(p, t) for p, t, _ in rows], "path string, target string")
    assert tuples(mark_links(df), "path", "target", "link_ok") == sorted(rows, key=repr)
    assert mark_links(df).filter("target = '../c'").first()["resolved"] == "a/c"


RELATIVE = [
    ("d/a.txt", "d/b.txt", "a.txt"),
    ("d/a.txt", "d/e/b.txt", "../a.txt"),
    ("d/x/a.txt", "d/e/b.txt", "../x/a.txt"),
    ("/d/a", "e/b", None),
    ("x/a", "../e/b", None),
    ("x", "x/", "."),
]


def test_relative_target(spark):
    df = spark.createDataFrame([(f, d) for f, d, _ in RELATIVE], "first string, dup string")
    got = df.withColumn("t", rel(dirname(F.col("dup")), F.col("first")))
    assert tuples(got, "first", "dup", "t") == sorted(RELATIVE, key=repr)


def test_walk_order(spark, tmp_path):
    for name in ("a-b/1", "a/z", "a/b/c", "b"):
        f = tmp_path / "one" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(name)
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "A").write_text("x")
    manifest = spark.createDataFrame(
        [(1, f"{tmp_path}/two/empty", "dir", None)],
        "arg_pos int, filepath string, kind string, modified_at timestamp",
    )
    found = scan_files(spark, [f"{tmp_path}/one", f"{tmp_path}/two"], manifest)
    rows = number_in_walk_order(found).orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(6))
    assert [r["filepath"].removeprefix(f"{tmp_path}/") for r in rows] == [
        "one/a/b/c", "one/a/z", "one/a-b/1", "one/b", "two/A", "two/empty",
    ]
    assert [r["size"] for r in rows] == [5, 3, 5, 1, 1, 0]


def test_old_spellings(spark):
    attrs = [
        {"checksum-type": "SHA1", "modtime": "t"},
        {"checksum-type": "SHA1", "checksumType": "MD5"},
        {"checksumType": "MD5", "file.lastModifiedTime": "t"},
    ]
    df = spark.createDataFrame([(a,) for a in attrs], "attrs map<string,string>")
    got = [r["attrs"] for r in canonical_attrs(df).collect()]
    assert got == [
        {"checksumType": "SHA1", "file.lastModifiedTime": "t"},
        {"checksumType": "MD5"},
        {"checksumType": "MD5", "file.lastModifiedTime": "t"},
    ]


def test_json_form(spark):
    text = '[{"Name":"path","Value":"./"},{"Name":"b","Value":"1"},{"Name":"b","Value":"2"}]'
    df = spark.createDataFrame([(text,)], "j string").select(attrs_from_json(F.col("j")).alias("a"))
    assert df.first()["a"] == {"path": "./", "b": "2"}
    assert df.select(attrs_to_json(F.col("a"))).first()[0] == (
        '[{"Name":"b","Value":"2"},{"Name":"path","Value":"./"}]'
    )


def test_stamping_keeps_the_chain_in_order(spark):
    df = spark.createDataFrame([({"custodyChain.12.time": "old", "k": "v"},)], "attrs map<string,string>")
    for i in range(3):
        df = stamp_hop(df, f"HOP{i}", host=f"h{i}", at=F.lit(f"t{i}"))
    got = df.first()["attrs"]
    assert got["custodyChain.15.time"] == "old" and got["k"] == "v"
    assert [got[f"custodyChain.{n}.action"] for n in range(3)] == ["HOP2", "HOP1", "HOP0"]
    assert [got[f"custodyChain.{n}.time"] for n in range(3)] == ["t2", "t1", "t0"]


def test_stamping_options(spark):
    df = spark.createDataFrame([({"a": "1"},)], "attrs map<string,string>")
    bare = stamp_hop(df, "", host="h", update_chain=False, static={"a": "2"}, at=F.lit("t")).first()["attrs"]
    assert bare == {"a": "2", "custodyChain.0.time": "t"}
    full = stamp_hop(
        df, "R", host="h", request={"request_uri": "/x", "local_host": "", "local_port": "1"}, at=F.lit("t")
    ).first()["attrs"]
    assert full == {
        "a": "1",
        "custodyChain.0.time": "t",
        "custodyChain.0.action": "R",
        "custodyChain.0.local.hostname": "h",
        "custodyChain.0.request.uri": "/x",
        "custodyChain.0.local.port": "1",
    }
    assert "custodyChain.0.time" in shift_chain(df).first()["attrs"]
    with pytest.raises(ValueError):
        stamp_hop(df, "R", request={"color": "red"})


def test_forwarded_for(spark):
    df = spark.createDataFrame([("",), ("9.9.9.9:1",), (None,)], "forwarded_for string")
    got = [r[0] for r in append_forwarded_for(df, "1.1.1.1:2").collect()]
    assert got == ["1.1.1.1:2", "1.1.1.1:2,9.9.9.9:1", "1.1.1.1:2"]


def test_segment_arithmetic(spark):
    df = spark.createDataFrame(
        [(1, "f", 25, bytearray(range(25)), "SHA256", "p", {"k": "v"}), (2, "g", 10, bytearray(10), "SHA256", "q", {})],
        "seq bigint, filename string, size bigint, content binary, checksum_type string, checksum string, "
        "attrs map<string,string>",
    )
    rows = segment(df, 10).filter("seq = 1").orderBy("fragment_index").collect()
    assert [(r["fragment_index"], r["fragment_offset"], r["size"]) for r in rows] == [(1, 0, 10), (2, 10, 10), (3, 20, 5)]
    assert b"".join(bytes(r["content"]) for r in rows) == bytes(range(25))
    last = rows[-1]["attrs"]
    assert last["fragment.count"] == "3" and last["fragment.index"] == "3" and last["k"] == "v"
    assert last["segment.original.size"] == "25" and last["segment.original.checksum"] == "p"
    assert len({r["uuid"] for r in rows}) == 3 and len({r["fragment_identifier"] for r in rows}) == 1
    whole = segment(df, 10).filter("seq = 2").first()
    assert whole["fragment_count"] is None and whole["checksum"] == "q" and whole["attrs"] == {}
    assert segment(df, 0).count() == 2
    assert [smaller_limit(*p) for p in ((0, 0), (0, 5), (5, 0), (5, 3))] == [0, 5, 5, 3]
