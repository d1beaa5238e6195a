"""Operators on vectors and pages against brute force and SQL, and the registered queries."""

from __future__ import annotations

import numpy as np
import pytest
from odd import CLASHING, CLASHING_VALUES, documents, no_documents
from oracle_check import compare, connect

import corpus_pipeline
from feedkit.llm import covertree, topk, urlrules
from feedkit.llm.queries import HOST_RULES, ORACLES, QUERIES
from feedkit.plans.settle import settle

SF = "/root/testdata/sf0.001"
VECTORS = f"vec_id bigint, embedding array<double>, label int, {CLASHING}"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, *CLASHING_VALUES) for i, v in rows], VECTORS).repartition(3)


def odd_vectors():
    choice = np.random.default_rng(1)
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [NAN, 1.0]), (20, [1.0, 0.0]), (6, [2.0, 0.0]), (7, [1.0, 0.0])]
    rows += [(8, [1.0, 0.0, 0.0]), (9, []), (10, [-0.0, 1.0]), (11, [0.0, 1.0]), (12, [INF, 1.0]), (13, [1e-200, 1e-200]), (14, [1e150, 1e150])]
    centres = choice.normal(size=(4, 6))
    for i in range(200):
        v = centres[i % 4] + choice.normal(size=6) * choice.choice([0.05, 0.2, 0.5])
        rows.append((100 + i, [float(x) for x in v]))
    rows += [(400 + i, [float(x) for x in choice.normal(size=2)]) for i in range(200)]
    return rows


def fit(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute_links(rows, cosine=0.9):
    root, links = {i: i for i, _ in rows}, dict.fromkeys((i for i, _ in rows), 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    good = [(i, np.array(v) / np.abs(v).max()) for i, v in rows if fit(v) and any(v)]
    good = [(i, v / np.linalg.norm(v)) for i, v in good]
    for k, (i, u) in enumerate(good):
        for j, v in good[:k]:
            if len(u) == len(v) and u @ v >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((i, links[i], find(i), i == find(i)) for i, _ in rows)


def test_cover_tree_equals_brute_force(spark):
    rows = odd_vectors()
    got = sorted(map(tuple, covertree.near_vectors(vectors(spark, rows)).collect()))
    assert got == brute_links(rows)


def test_cover_tree_over_several_nodes_and_blocks(spark, monkeypatch):
    """Small blocks: top levels with several nodes, and nodes with several blocks."""
    monkeypatch.setattr(covertree, "rows_a_block", lambda dim, width: 24)
    rows = odd_vectors()
    got = sorted(map(tuple, covertree.near_vectors(vectors(spark, rows)).collect()))
    assert got == brute_links(rows)


def test_cover_tree_covers():
    points = covertree.directions(np.random.default_rng(3).normal(size=(200, 3)))
    tree = covertree.Tree(points)
    for radius, (centres, cover, _, _) in zip(covertree.RADII, tree.levels[1:-1]):
        gaps = np.sqrt(((points[centres][:, None] - points[centres][None]) ** 2).sum(axis=2))
        assert (gaps[~np.eye(len(centres), dtype=bool)] > radius - 1e-3).all()
        assert set(tree.levels[1][0]) <= set(centres)
        assert cover.max() <= 2 * radius + 1e-3


def test_vectors_of_nothing(spark):
    assert covertree.near_vectors(vectors(spark, [(1, None)]).limit(0)).count() == 0
    assert topk.top_k(vectors(spark, [(1, None)]).limit(0), lambda i: i % 20 == 0).count() == 0
    assert covertree.near_vectors(vectors(spark, [(1, None)])).count() == 1


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "RANGE_ROWS", 50)
    rows = [r for r in odd_vectors() if r[0] != 14] + [(None, [1.0, 1.0])]
    got = sorted(map(tuple, topk.top_k(vectors(spark, rows), lambda i: i % 20 == 0, 7).collect()))
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and fit(v)]
    want = []
    for i, q in whole:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:7])]
    assert got == sorted(want)


def test_top_k_skips_blocks():
    """Blocks under the k-th score are not scored."""
    rows = np.zeros((64 * 20, 8))
    rows[np.arange(len(rows)), np.arange(len(rows)) % 8] = np.arange(len(rows)) % 64
    calls = []
    dots = topk._dots
    topk._dots = lambda q, r: calls.append(len(r)) or dots(q, r)
    try:
        topk.best_rows(np.array([-1]), np.eye(8)[:1] * 5, np.arange(len(rows)), rows, 3)
    finally:
        topk._dots = dots
    assert sum(calls) < len(rows) / 2


URLS = [
    "http://A.Example.com/en/x?q", "https://www.example.com/en/", "example.com/en/", None, "", "://", "x://Host.NET/fr/a#b",
    "http://net/es/", "http://sub.net/ES/", "http://notexample.com/en/", "http://cheap-pills.x.org/", "http://www.Casino-Win.org/",
    "ftp://a.b.com", "http://com/", "http://é.com/ü", "http://x.com/a://b.net/es/", "http://u@x.net:80/fr/", "http://x.org/ads/1",
    "http://a.adserver.b.org", "http://x.org/" + "a/" * 20000, "http://x.org/\nads/",
]


def test_url_rules_equal_sql(spark, tmp_path):
    import duckdb

    rows = [(i, u, *CLASHING_VALUES) for i, u in enumerate(URLS * 2)] + [(None, URLS[0], *CLASHING_VALUES), (0, URLS[0], *CLASHING_VALUES)]
    pages = spark.createDataFrame(rows, f"page_id bigint, url string, {CLASHING}")
    got = urlrules.judge_urls(
        pages, [urlrules.host_rule(*r) for r in HOST_RULES], [urlrules.pattern_rule(*r) for r in urlrules.PATTERNS]
    )
    con = duckdb.connect()
    frame = pages.select("page_id", "url").toPandas()  # noqa: F841
    con.execute("create table pages as select cast(page_id as bigint) as page_id, url from frame")
    assert compare(got.toPandas(), con.execute(ORACLES["op10_url_rules"]).df()) == ""
    assert urlrules.judge_urls(pages.limit(0), [], []).count() == 0


def test_url_patterns_equal_a_plain_matcher(spark):
    import re

    patterns = ["||shop.", "*track*id=^", "*/ads^*", "||x^", "*a*b*c*", "*.gif", "||net^fr"]
    urls = ["http://shop.a.com/x", "http://a.shop.b/track", "http://x/ads/y", "http://x", "http://aXbYc.d", "http://q/i.gif", "http://a.net/fr"]

    def matches(pattern, text):
        anchored = pattern.startswith("||")
        body = pattern[2:] if anchored else pattern
        regex = "".join(".*" if c == "*" else r"(?:[^a-z0-9_.%-]|$)" if c == "^" else re.escape(c) for c in body)
        start = r"^(?:[^/]*\.)?" if anchored else ""
        return re.search(start + regex, text, re.S) is not None

    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = urlrules.judge_urls(pages, [], [urlrules.pattern_rule("block", p) for p in patterns])
    for r in got.collect():
        fit = [p for p in patterns if matches(p, (r["host"] + r["path"]).lower())]
        assert r["pattern"] == max(fit, key=lambda p: (len(p), p), default=None), (r, fit)


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()) == ""


def test_registry():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]
    assert {f"op{i}" for i in range(1, 11)} == {n.split("_")[0] for n in QUERIES}


@pytest.mark.parametrize("make", [documents, no_documents])
def test_stages_keep_columns_and_stand_odd_rows(spark, make):
    docs = make(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
    if make is no_documents:
        assert docs.count() == 0


def test_pipeline_runs_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fill = {r["s"]: r["n"] for r in rows.groupBy("sequence_id").sum("length").toDF("s", "n").collect()}
    assert all(n == 2048 or n & (n - 1) == 0 for n in fill.values())


def test_pipeline_keeps_one_row_of_each_group_whatever_the_ids(spark):
    """Rows that share an id or have none are judged by their own texts, against all pairs by brute force."""
    base = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcd"}
    near = base["a"].replace("a30", "other")
    rows = [(7, base["a"]), (8, near), (8, base["b"]), (None, base["a"]), (None, base["a"]), (None, base["c"]), (9, base["d"]), (9, base["d"]), (9, None), (9, ""), (None, "few words"), (10, "few words")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    got = corpus_pipeline.without_near_duplicates(spark, docs, SF)
    assert got.schema == docs.schema

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(kept) == len(set(group))
    left = [shingles(t) for _, t in kept]
    assert all(not a or not b or 100 * len(a & b) < 80 * len(a | b) for i, a in enumerate(left) for b in left[:i])
    assert all(any(s == t or (s and t and 100 * len(s & t) >= 80 * len(s | t)) for t in left) for s in sets)
    assert {(8, base["b"]), (None, base["c"]), (9, None), (9, "")} <= set(kept)
