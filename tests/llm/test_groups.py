"""The source audit and the centroid clustering against brute force in plain integers."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from odd import CLASHING, CLASHING_VALUES, DOCS, documents, no_documents, texts

from feedkit.llm import divergence, vantage

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def brute_audit(rows, least, top):
    """rows: (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [(s, Counter(TERM.findall(t.translate(UPPER)))) for g, s, t in rows if g == lang]
        df = Counter(t for _, c in own for t in c)
        kept = {t for t, n in df.items() if n >= least}
        counts = {s: Counter() for s, _ in own}
        for s, c in own:
            counts[s].update({t: n for t, n in c.items() if t in kept})
        whole = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for s, c in counts.items():
            found = {"pair": [], "term": []}
            for o, d in counts.items():
                if o != s:
                    found["pair"].append((sum((p(c, t) - p(d, t)) ** 2 // p(d, t) for t in kept), o))
            for t in kept:
                if c[t] and p(c, t) > p(whole, t):
                    found["term"].append(((p(c, t) - p(whole, t)) ** 2 // p(whole, t), t))
            for part, items in found.items():
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                items = items if part == "pair" else items[:top]
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(items)]
    return sorted(out)


def audited(df, least=3, top=200):
    return sorted(map(tuple, divergence.audit(df, least, top).select("lang", "source", "part", "item", "value", "rank").collect()))


def audit_rows():
    choice = random.Random(8)
    rows = [(None, None, None), ("xx", "s", ""), ("xx", "s", "1 2 3"), ("yy", "only", "a a b"), (None, "", "Été été ÉTÉ"), ("", "q", "été e")]
    words = ["alpha", "Beta", "GAMMA", "delta9eps", "naïve", "中文", "İx", "a\0b", "[x]", "z@z"]
    for i in range(300):
        lang = choice.choice(["en", "en", "de", "fr"])
        source = "hot" if choice.random() < 0.4 else choice.choice(["s1", "s2", "é", "", "Z"])
        rows.append((lang, source, " ".join(choice.choice(words) + choice.choice(["", "x", "y"]) for _ in range(choice.randint(0, 30)))))
    rows += [("en", "s1", "longword" * 20_000), ("en", "s1", "longword" * 20_000), ("en", "s2", "longword" * 20_000), ("en", "s2", "many " * 100_000)]
    return rows


def with_docs(spark, rows):
    full = [(i % 7, t, g, s, 0, *CLASHING_VALUES) for i, (g, s, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCS).repartition(4)


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_brute_force(spark, monkeypatch, small):
    if small:  # stripes spill all the time, many buckets, blocks of few sources
        monkeypatch.setattr(divergence, "MOST_COUNTS", 5)
        monkeypatch.setattr(divergence, "BUCKET_COUNTS", 7)
        monkeypatch.setattr(divergence, "CELLS", 8)
    rows = audit_rows()
    assert audited(with_docs(spark, rows)) == brute_audit(rows, 3, 200)
    assert audited(with_docs(spark, rows), 1, 4) == brute_audit(rows, 1, 4)


def test_audit_of_odd_and_no_rows(spark):
    assert audited(documents(spark), 2) == brute_audit([(None, s, t) for _, t, s in texts()], 2, 200)
    assert audited(no_documents(spark)) == []


def test_shares_are_exact():
    choice = random.Random(9)
    for _ in range(2000):
        whole = choice.randint(1, 9 * 10**15)
        n = choice.randint(0, whole - 1)
        assert divergence.share(np.array([n]), whole)[0] == 1 + 10**9 * (n + 1) // whole


# --- clustering


def brute_cluster(rows, k, rounds, dim, seed="3:"):
    kept = [(i, [(int(x) * 1024 if abs(x) > 2**53 else int(np.floor(1024 * x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"{seed}{r[0]}".encode()).hexdigest(), r[0], r[1]))
    centroids = [r[1] for r in [*named, *(r for r in kept if r[0] is None)][:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(x) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    sums = Counter()
    for _, d, j in found:
        sums[j] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def long(x):
        return x if x < 2**63 else None

    return sorted(((i, j, long(d), long(sums[j]), long(sum(sums.values())), name[j]) for i, d, j in found), key=repr)


def vectors(spark, rows):
    schema = f"vec_id bigint, embedding array<double>, label int, cluster int, distance string, {CLASHING}"
    return spark.createDataFrame([(i, v, 1, 2, "d", *CLASHING_VALUES) for i, v in rows], schema).repartition(3)


def odd_rows(dim, large=False):
    choice = np.random.default_rng(2)
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [nan] * dim), (4, [inf] * dim), (5, [None] * dim), (6, [0.0] * (dim + 1)), (None, [0.5] * dim)]
    rows += [(7, [-0.0] * dim), (8, [0.0] * dim), (8, [0.0] * dim), (9, [-0.0001] * dim)]
    centres = choice.normal(size=(5, dim))
    for i in range(200):
        rows.append((20 + i, (centres[i % 5] + choice.normal(size=dim) * 0.3).round(2).tolist()))
    rows += [(20 + i, [1.25] * dim) for i in range(60)]  # many equal ones, with ids seen before
    return [*rows, (500, [1e200] * dim), (501, [-3e30] * dim), (502, [1.7e308] * dim), (503, [3e5] * dim)] if large else rows


def clustered(spark, rows, **given):
    got = vantage.cluster(vectors(spark, rows), **given).collect()
    return sorted(map(tuple, got), key=repr)


@pytest.mark.parametrize("k, dim", [(8, 4), (1, 4), (40, 3)])
def test_clusters_equal_brute_force(spark, k, dim):
    rows = odd_rows(dim)
    assert clustered(spark, rows, k=k, rounds=3, dim=dim) == brute_cluster(rows, k, 3, dim)


def test_clusters_of_large_numbers(spark):
    rows = odd_rows(4, large=True)
    assert clustered(spark, rows, k=6, rounds=3, dim=4) == brute_cluster(rows, 6, 3, 4)


def test_clusters_of_few_rows_and_none(spark):
    few = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)]
    assert clustered(spark, few, k=8, rounds=2, dim=2) == brute_cluster(few, 8, 2, 2)
    assert clustered(spark, [(1, None)], k=8, rounds=2, dim=2) == []
    assert clustered(spark, [], k=8, rounds=2, dim=2) == []


def test_tree_prunes_and_is_exact():
    choice = np.random.default_rng(4)
    centroids = (choice.normal(size=(64, 8)) * 2000).astype(int)
    centroids[10] = centroids[3]  # equal centroids: the smaller number holds
    rows = (centroids[choice.integers(0, 64, 500)] + choice.normal(size=(500, 8)) * 20).astype(np.int64)
    tree = vantage.Tree.over(centroids.tolist())
    calls = []
    plain = vantage.squares
    try:
        vantage.squares = lambda r, c: (calls.append(len(r)), plain(r, c))[1]
        chosen, distance = tree.nearest(rows)
    finally:
        vantage.squares = plain
    every = ((rows[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (chosen == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert sum(calls) < 0.6 * every.size  # most branches are never opened
    large, far = tree.nearest(rows.astype(object))
    assert (large == chosen).all() and (far == distance).all()
