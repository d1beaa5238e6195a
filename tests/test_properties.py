"""Random cases against plain-Python models, many cases per Spark job."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedkit.functions.paths import clean, join, rel
from feedkit.operators.checksum import add_checksum
from feedkit.operators.dedup import dedup_to_links, resolve_links
from feedkit.operators.fragments import (
    fragment_status,
    latest_attempt,
    missing_fragments,
    reassemble,
    segment,
)
from feedkit.operators.frames import inflight_runs, reassemble_frames, run_status
from feedkit.operators.sequence import sequence_gaps, sequence_release
from feedkit.plans.quantiles import exact_summary
from helpers import tuples

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def plain_clean(path):
    rooted, stack = path.startswith("/"), []
    for part in path.split("/"):
        if part in ("", "."):
            continue
        if part == ".." and stack and stack[-1] != "..":
            stack.pop()
        elif part == ".." and rooted:
            continue
        else:
            stack.append(part)
    body = "/".join(stack)
    return "/" + body if rooted else body or "."


def random_paths(rng, n):
    parts = ["a", "b", "..", ".", "", "..x"]
    return ["/".join(rng.choices(parts, k=rng.randint(0, 6))) for _ in range(n)]


def test_clean_and_rel_on_random_paths(spark):
    rng = random.Random(1)
    a, b = random_paths(rng, 1500), random_paths(rng, 1500)
    df = spark.createDataFrame(list(zip(a, b)), "a string, b string")
    got = df.select(
        "a", "b", clean(F.col("a")).alias("ca"), rel(F.col("a"), F.col("b")).alias("r")
    ).withColumn("back", join(F.col("a"), F.col("r")))
    for row in got.collect():
        assert row["ca"] == plain_clean(row["a"])
        if row["r"] is not None and row["a"] != "":
            assert row["back"] == plain_clean(row["b"]), row


@SLOW
@given(st.lists(st.binary(min_size=0, max_size=60), min_size=1, max_size=6), st.integers(1, 25), st.randoms())
def test_segment_then_reassemble_is_the_identity(spark, payloads, piece, rng):
    rows = [(i, f"f{i}", len(p), bytearray(p)) for i, p in enumerate(payloads)]
    files = add_checksum(spark.createDataFrame(rows, "seq bigint, filename string, size bigint, content binary"))
    cut = segment(files, piece).filter("fragment_count is not null").collect()
    fragments = [
        (r["fragment_identifier"], r["fragment_index"], r["fragment_count"], bytearray(r["content"]),
         r["orig_size"], r["orig_checksum_type"], r["orig_checksum"])
        for r in cut
        for _ in range(rng.randint(1, 3))
    ]
    if not fragments:
        return
    rng.shuffle(fragments)
    schema = (
        "identifier string, idx bigint, cnt bigint, part binary, orig_size bigint, "
        "orig_checksum_type string, orig_checksum string, arrival bigint"
    )
    got = reassemble(spark.createDataFrame([(*f, i) for i, f in enumerate(fragments)], schema)).collect()
    large = [p for p in payloads if len(p) > piece]
    assert sorted(bytes(r["content"]) for r in got) == sorted(large)
    assert {r["state"] for r in got} == {"complete"}


@SLOW
@given(st.lists(st.sampled_from([b"", b"x", b"yy", b"zzz"]), min_size=1, max_size=20), st.randoms())
def test_dedup_then_resolve_restores_every_checksum(spark, payloads, rng):
    folders = ["d", "d/e", "d/x/y", "q"]
    rows = [(i, rng.choice(folders), f"f{i}", len(p), bytearray(p)) for i, p in enumerate(payloads)]
    files = add_checksum(
        spark.createDataFrame(rows, "seq bigint, path string, filename string, size bigint, content binary")
    )
    deduped = dedup_to_links(files)
    links, kept = deduped.filter("kind = 'link'"), deduped.filter("kind <> 'link'")
    restored = resolve_links(kept, links).collect()
    assert len(restored) == sum(1 for i, p in enumerate(payloads) if p and p in payloads[:i])
    for r in restored:
        assert r["link_state"] == "resolved"
        assert bytes(r["resolved_content"]) == payloads[r["seq"]]
        assert r["checksum"] == r["resolved_checksum"]


def released_by_simulation(packets):
    """Packet by packet, as a receiver works."""
    nxt, waiting, out = 1, {}, []
    for arrival, n, op in sorted(packets):
        if n < nxt:
            continue
        if n > nxt:
            waiting[n] = (arrival, op)
            continue
        copy = (arrival, op)
        while copy is not None:
            out.append((nxt, copy[0], arrival))
            nxt += 1
            if copy[1] == "EOF":
                return out
            copy = waiting.pop(nxt, None)
    return out


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_release_equals_simulation(spark, parts):
    rng = random.Random(parts)
    rows, want, gaps = [], [], []
    for s in range(150):
        count = rng.randint(1, 9)
        numbers = [n for n in range(1, count + 1) for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))]
        rng.shuffle(numbers)
        end = rng.choice([count, count, rng.randint(1, count), 0])
        packets = [(a, n, "EOF" if n == end and rng.random() < 0.8 else "") for a, n in enumerate(numbers)]
        rows += [(f"s{s}", n, op, a, f"{s}/{a}".encode()) for a, n, op in packets]
        want += [(f"s{s}", n, used, at) for n, used, at in released_by_simulation(packets)]
        prev = 0
        for n in sorted(set(numbers)):
            if n - prev > 1:
                gaps.append((f"s{s}", prev + 1, n - 1))
            prev = n
    df = spark.createDataFrame(rows, "socket_id string, n bigint, op string, arrival bigint, payload binary")
    got = sequence_release(df, parts=parts, salts=4)
    assert tuples(got, "socket_id", "n", "arrival", "released_at") == sorted(want, key=repr)
    payloads = {(r["socket_id"], r["n"]): bytes(r["payload"]).decode() for r in got.collect()}
    assert all(payloads[s, n] == f"{s[1:]}/{a}" for s, n, a, _ in want)
    assert tuples(sequence_gaps(df, parts=parts), "socket_id", "from_n", "to_n") == sorted(gaps, key=repr)


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_attempts_equal_simulation(spark, parts):
    rng = random.Random(parts)
    rows, want = [], []
    for p in range(60):
        current, kept, at = None, [], 0
        for _ in range(rng.randint(1, 14)):
            at += rng.randint(1, 4)
            ident, idx, cnt = rng.choice("AB"), rng.randint(0, 5), 4
            rows.append((f"p{p}", ident, idx, cnt, at))
            if not 1 <= idx <= cnt:
                continue
            if ident != current:
                current, kept = ident, []
            kept.append((f"p{p}", ident, idx, at))
        want += kept
    df = spark.createDataFrame(rows, "path string, identifier string, idx bigint, cnt bigint, arrival bigint")
    got = latest_attempt(df, ["path"], parts=parts)
    assert tuples(got, "path", "identifier", "idx", "arrival") == sorted(want, key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_runs_of_frames_equal_simulation(spark, parts):
    rng = random.Random(parts)
    rows, want = [], []
    for port in range(30):
        run, totals = None, {u: rng.randint(1, 4) for u in "abc"}
        runs = []
        for at in range(rng.randint(1, 25)):
            if run is None or rng.random() < 0.3:
                uuid = rng.choice("abc")
                if run is None or uuid != run["uuid"]:
                    run = {"uuid": uuid, "start": at, "seen": set(), "frames": 0, "total": totals[uuid]}
                    runs.append(run)
            slot = rng.randint(-1, totals[run["uuid"]])
            payload = None if slot < 0 else bytearray(b"x")
            rows.append((port, at, run["uuid"], totals[run["uuid"]] * 100, max(slot, 0) * 100, 100, payload))
            if 0 <= slot < run["total"]:
                run["seen"].add(slot)
                run["frames"] += 1
        for i, r in enumerate(runs):
            full = len(r["seen"]) == r["total"]
            state = "complete" if full else "abandoned" if i < len(runs) - 1 else "incomplete"
            want.append((port, r["uuid"], r["start"], r["total"], len(r["seen"]), r["frames"] - len(r["seen"]), state))
    df = spark.createDataFrame(
        rows, "port int, arrival bigint, uuid string, size bigint, offset bigint, mtu int, payload binary"
    )
    got = run_status(df, parts=parts)
    assert tuples(got, "port", "uuid", "run_start", "total", "seen", "dups", "state") == sorted(want, key=repr)
    marked = inflight_runs(df, parts=parts)
    assert marked.count() == df.count()
    starts = {(r["port"], r["uuid"], r["run_start"]) for r in marked.collect()}
    assert starts == {w[:3] for w in want}


def test_missing_fragments_of_any_shape(spark):
    rng = random.Random(7)
    rows, want = [], []
    for f in range(80):
        cnt = rng.randint(2, 12)
        seen = rng.sample(range(1, cnt + 1), rng.randint(1, cnt))
        rows += [(f"f{f}", i, cnt) for i in seen for _ in range(rng.randint(1, 2))]
        rows.append((f"f{f}", cnt + 3, cnt))
        want += [(f"f{f}", i) for i in range(1, cnt + 1) if i not in seen]
    df = spark.createDataFrame(rows, "identifier string, idx bigint, cnt bigint")
    for parts in (1, 5, None):
        assert tuples(missing_fragments(df, parts=parts), "identifier", "idx") == sorted(want, key=repr)
    states = {r["identifier"]: r["state"] for r in fragment_status(df).collect()}
    short = {f for f, _ in want}
    assert all((s == "incomplete") == (f in short) for f, s in states.items())


def test_missing_fragments_spells_out_long_ranges(spark):
    df = spark.createDataFrame([("f", 5, 35_000)], "identifier string, idx bigint, cnt bigint")
    got = missing_fragments(df)
    assert got.count() == 34_999
    assert got.agg(F.min("idx"), F.max("idx"), F.count_distinct("idx")).first()[:] == (1, 35_000, 34_999)


def test_exact_summary_matches_interpolation(spark):
    rng = np.random.default_rng(3)
    groups = {
        "wide": rng.integers(-(10**15), 10**15, 900),
        "same": np.full(300, 42),
        "few": np.array([5, 9]),
        "one": np.array([-7]),
        "tiny": rng.integers(-3, 4, 400),
        "heavy": np.concatenate([np.zeros(500, dtype=int), rng.integers(1, 10**9, 500)]),
    }
    rows = [(g, int(x)) for g, xs in groups.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, x bigint")
    wanted = {"lo": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "hi": 1.0}
    got = {r["g"]: r for r in exact_summary(df, ["g"], "x", wanted).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        assert (got[g]["n"], int(got[g]["sum"]), got[g]["max"]) == (len(xs), sum(map(int, xs)), max(xs))
        for name, q in wanted.items():
            assert got[g][name] == pytest.approx(float(np.quantile(xs, q)), rel=1e-12, abs=1e-6), (g, name)


def test_frames_with_repeats_and_wrong_sizes(spark):
    body = bytes(range(250))

    def frame(uuid, at, off, size=250, data=None):
        return (uuid, at, size, off, 100, bytearray(body[off : off + 100] if data is None else data))

    rows = [frame("ok", 3, 100), frame("ok", 1, 0), frame("ok", 2, 0, data=b"late"), frame("ok", 5, 200)]
    rows += [frame("short", 1, 0), frame("short", 2, 100), frame("short", 3, 200, data=b"x")]
    rows += [frame("open", 1, 0)]
    df = spark.createDataFrame(rows, "uuid string, arrival bigint, size bigint, offset bigint, mtu int, payload binary")
    sums = spark.createDataFrame(
        [("ok", "SHA256", hashlib.sha256(body).hexdigest()), ("short", "SHA256", "0")],
        "uuid string, checksum_type string, checksum string",
    )
    got = {r["uuid"]: r for r in reassemble_frames(df, sums).collect()}
    assert set(got) == {"ok", "short"}
    assert got["ok"]["accepted"] and bytes(got["ok"]["content"]) == body
    assert got["short"]["assembly"] == "corrupt" and not got["short"]["accepted"]
    # In a tiny cell no payload fits, and the verdicts are the same.
    for cell in (200, 0):
        small = {r["uuid"]: r for r in reassemble_frames(df, sums, max_cell=cell).collect()}
        for uuid, row in small.items():
            assert [row[c] for c in ("assembly", "state", "accepted", "size")] == [got[uuid][c] for c in ("assembly", "state", "accepted", "size")]
        assert small["ok"]["content"] is None
