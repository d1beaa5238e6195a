"""Operators on documents against brute force, on tables with everything odd."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import documents, no_documents, texts
from pyspark.sql import functions as F

from feedkit.llm import components, mixing, neardup, packing, pii, quality, repeats, tokenfiles
from feedkit.llm.queries import tokenizer_file
from feedkit.llm.suffixes import suffix_array
from feedkit.llm.wordids import WordEncoder
from feedkit.llm.wordmemory import WordMemory


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain_ids(strings):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    return [e.ids for e in tokenizer.encode_batch(strings, add_special_tokens=False)]


# --- 1, quality


def test_ratios_and_descent_separate_classes():
    made = quality.Features()
    good = [made.of(f"the quiet {w} of the house".encode()) for w in "abcdefghij"]
    bad = [made.of(f"BUY {w}!! NOW!! &&&".encode()) for w in "abcdefghij"]
    model = quality.fit(good + bad, np.array([True] * 10 + [False] * 10))
    assert min(model.margin(x) for x in good) > max(model.margin(x) for x in bad)
    assert all(0 <= model.score(x) <= 1 for x in good + bad + [made.of(b"")])


def test_descent_reaches_the_optimum():
    """The duality gap closes: the primal value equals the dual's."""
    choice = np.random.default_rng(5)
    rows = [np.unique(choice.integers(0, 40, 8)).astype(np.int32) for _ in range(60)]
    signs = np.where([len(r) and r[0] < 5 for r in rows], 1.0, -1.0)
    ratios = choice.normal(size=quality.SIZE).astype(np.float32)
    old, quality.ROUNDS = quality.ROUNDS, 3000
    try:
        weights, bias = quality.descend(rows, signs, ratios)
    finally:
        quality.ROUNDS = old
    x = [ratios[r] / np.linalg.norm(ratios[r]) for r in rows]
    margins = np.array([weights[r] @ v + bias for r, v in zip(rows, x)])
    loss = np.maximum(0, 1 - signs * margins).sum() * quality.COST
    primal = 0.5 * (weights @ weights + bias * bias) + loss
    for nudge in range(20):  # no nearby point is better
        w, b = weights.copy(), bias + choice.normal() * 1e-2
        w[:40] += choice.normal(size=40) * 1e-2
        m = np.array([w[r] @ v + b for r, v in zip(rows, x)])
        assert 0.5 * (w @ w + b * b) + np.maximum(0, 1 - signs * m).sum() >= primal - 1e-3


def test_quality_on_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (7, 0), (9, 0), (None, 1), (3, None)], "doc_id bigint, quality int")
    docs = documents(spark)
    model = quality.train(docs, labels, ~quality.held_out(quality.F.col("doc_id")))
    scored = quality.score(docs, model).collect()
    assert len(scored) == len(texts()) and all(0 <= r["score"] <= 1 for r in scored)
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema
    empty = quality.train(no_documents(spark), labels, quality.F.lit(True))
    assert {r["score"] for r in quality.score(docs, empty).collect()} == {0.5}
    assert quality.score(no_documents(spark), model).count() == 0


def test_quality_held_out_accuracy(spark):
    from feedkit.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = QUERIES["op1_nb_svm"](spark, sf).filter("held_out").join(labels, "doc_id").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9
    assert (got.predicted[got.quality == 1] == 1).mean() > 0.97


def test_words_of_any_length_are_hashed_whole(monkeypatch):
    from feedkit.llm import hashing

    far = b"x" * (2 << 20)
    found, counts = hashing.word_hashes([far + b"bc" * 50, far + b"cb" * 50, b"abc " + far, far])
    assert counts.tolist() == [1, 1, 2, 1] and len(set(found.tolist())) == 4 and found[3] == found[4]
    words = [b"abcdefghijklmnopqrstuvwxyz" * 300, b"z" * 40, b"y"]
    whole, _ = hashing.word_hashes(words)
    monkeypatch.setattr(hashing, "FAR", 16)
    monkeypatch.setattr(hashing, "_POWERS", [hashing._powers(8)])
    assert hashing.word_hashes(words)[0].tolist() == whole.tolist()


# --- 2, personal data

RULES = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute_spans(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0

    tests = (
        lambda s: True,
        lambda s: all(int(p) <= 255 for p in s.split(".")),
        lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s)),
        lambda s: 9 <= len(digits(s)) <= 15,
    )
    return sorted((m.start(), k, m.end()) for k, (r, t) in enumerate(zip(RULES, tests)) for m in re.finditer(r, text) if t(m[0]))


def test_rules_equal_plain_patterns():
    choice = random.Random(1)
    parts = ["1", "55", "4111 1111 1111 1111", ".", ".", " ", "-", "+", "(", ")", "@", "a", "b.c", "x@y.z", "1.2.3.4", "+1 (017) 555-7713", "é", "%", "_", "256", "٣"]
    for _ in range(5000):
        text = "".join(choice.choice(parts) for _ in range(choice.randint(0, 14)))
        assert pii.base_spans(text) == brute_spans(text), text


@functools.cache
def trained():
    choice, examples = random.Random(2), []
    for i in range(60):
        texts = (
            f"ask u{i}.x@host{i}.example.com for more",
            f"from {i}.{i + 3}.17.{200 - i} came",
            f"paid by 4111 1111 1111 1111 then",
            f"call +1 ({i + 100}) 555-{1000 + i} now",
        )
        for t in texts:
            examples += pii.lessons(t, choice)
        examples += pii.lessons(f"in {1900 + i} there were {i * 7919 + 10_000_000} things", choice)
    return pii.learn(examples)


def test_field_finds_rewritten_forms_and_leaves_numbers():
    field = trained()

    def added(text):
        return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.added_spans(text, pii.base_spans(text), field)]

    assert added("ask und.34 at mail7 dot example dot com for more") == [("email", "und.34 at mail7 dot example dot com")]
    assert added("call (017) 555-7713 now") == [("phone", "(017) 555-7713")]
    assert added("in 1987 there were 12345678 things") == []
    assert added("look at the dot over there") == []


def test_field_sees_numbers_beside_spans_of_rules():
    field, number = trained(), "(212) 555-0143"
    for span, kind in (("10.0.0.12", 1), ("4111 1111 1111 1111", 2), ("+1 (017) 555-7713", 3), ("me@host.example.org", 0)):
        for sign in (" ", " / ", "; ", "/", " - ", "\n"):
            for text in (f"call {number}{sign}{span} today", f"call {span}{sign}{number} today", f"call {number}{sign}{span}{sign}{number} today"):
                base = pii.base_spans(text)
                if [(text[a:b], k) for a, k, b in base] != [(span, kind)]:
                    continue  # the rules read both as one
                windows = pii.windows_of(text, base)
                at = text.find(number)
                while at >= 0:
                    assert any(a <= at and at + len(number) <= b for a, b in windows), (text, windows)
                    at = text.find(number, at + 1)
                assert all(b <= s or e <= a for a, b in windows for s, _, e in base)
    text = f"call {number} 10.0.0.12 today"
    more = pii.added_spans(text, pii.base_spans(text), field)
    assert [(text[a:b], pii.KINDS[k]) for a, k, b in more] == [(number, "phone")]
    assert pii.masked(text, pii.base_spans(text) + more) == "call <PHONE> <IP> today"


def test_windows_and_segments_hold_whole_addresses():
    long_host = " dot ".join(["a-long-label-of-a-host-for-one-more-example"] * 3)
    for entity in (
        "alexander.hamilton at engineering dot example dot org",
        "name at example.com",
        "name (at) example.com",
        "name at mail . example . com",
        "john.smith [at] mail [dot] example [dot] com",
        "a.very-long_name.of+somebody.else.2024 ( at ) mail-01 ( dot ) eu-west ( dot ) example ( dot ) co ( dot ) uk",
        f"{'very-long-name-' * 4}x at {long_host}",
        ".".join("abcdefghijklmnopqrstuvwxyz") + "[at]" + "[dot]".join("abcdefghijklmnopqrstuvwxyz"),
    ):
        for text in (entity, f"ask {entity} for more", f"or 10.0.0.12 {entity} 10.0.0.12"):
            begin = text.index(entity)
            spans = pii.base_spans(text)
            own = [(a, b) for a, b in pii.windows_of(text, spans) if a <= begin and begin + len(entity) <= b]
            assert len(own) == 1, text
            window = pii.read_window(text, *own[0])
            found = {(window.bounds[i][0], window.bounds[j - 1][1]) for i, j in window.segments}
            assert (begin, begin + len(entity)) in found, text
    assert pii.windows_of("We arrived at noon. Then it rained, at last, on us", []) == []


def test_every_rewritten_form_is_a_lesson():
    choice, entities = random.Random(5), (
        "first.middle.last+tag-2024_x@mail-01.eu-west.example.co.uk",
        "a.b.c.d.e.f.g.h@i.j.k.l.m.n.o.p.at",
        "10.200.30.4",
        "4111 1111 1111 1111",
        "+1 (017) 555-7713",
    )
    for text in entities:
        ((_, kind, _),) = pii.base_spans(text)
        for body in {pii.rewritten(kind, text, choice) for _ in range(60)}:
            window = pii.read_window(f"see {body} now", 0, len(body) + 8)
            found = {(window.bounds[i][0], window.bounds[j - 1][1]) for i, j in window.segments}
            assert (4, 4 + len(body)) in found, body


def test_field_masks_whole_addresses():
    choice, examples = random.Random(3), []
    names = "john mary alexander hamilton smith brown elizabeth taylor washington lee".split()
    for _ in range(60):
        one, two, host = choice.choice(names), choice.choice(names), choice.choice(("mail", "engineering", "post", "office"))
        examples += pii.lessons(f"ask {one}.{two}@{host}.example.{choice.choice(('org', 'com'))} for more", choice)
    field = pii.learn(examples)
    for entity in ("alexander.hamilton at engineering dot example dot org", "john.smith [at] mail [dot] example [dot] com"):
        text = f"ask {entity} for more"
        assert pii.masked(text, pii.added_spans(text, [], field)) == "ask <EMAIL> for more"


def test_a_rare_kind_is_learned_wherever_it_is(spark):
    """Addresses in three of 8,000 documents, which a sample of ids by hash may leave out, and many copies."""
    order = spark.range(8000).orderBy(F.xxhash64("id", F.lit(5)), "id").collect()
    rare = {r["id"]: i for i, r in enumerate(order[-3:])}
    rows = [
        (i, f"ask u{rare[i]}.x@host{rare[i]}.example.com for more" if i in rare else "from 10.3.17.20 came" if i % 2 else "nothing")
        for i in range(8000)
    ]
    seen = pii.train(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert np.abs(seen.weights[0]).max() > 0 and np.abs(seen.weights[1]).max() > 0
    lessons = [x for i in sorted(rare) for x in pii.lessons(rows[i][1], random.Random(zlib.crc32(rows[i][1].encode())))]
    bodies = [(body, s[0]) for body, s in lessons if s and "@" not in body[s[0][0] : s[0][2]]]
    for body, (a, k, b) in bodies:
        assert (a, k, b) in pii.added_spans(body, [], seen), body


def test_field_program_equals_enumeration():
    choice = np.random.default_rng(7)
    field = pii.Field(choice.normal(size=(len(pii.KINDS), pii.FEATURES)), choice.normal(size=(5, 5)))
    for text in ("a 1234567 b", "1.2.3.4 5", "x 12 3456789 y", "+1 2345678"):
        window = pii.read_window(text, 0, len(text))
        scores, n = field.scores(window), len(window.bounds)
        ways = {}

        def walk(t, label, total, made, scores=scores, n=n, window=window, ways=ways):
            if t == n:
                ways[tuple(made)] = total
                return
            walk(t + 1, 0, total + field.follows[label, 0], made)
            for s, (i, j) in enumerate(window.segments):
                if i == t:
                    for k in range(len(pii.KINDS)):
                        walk(j, k + 1, total + field.follows[label, k + 1] + scores[s, k], [*made, (i, k, j)])

        walk(0, 0, 0.0, [])
        tokens = pii.Tokens([(text, 0, len(text))])
        assert tuple(field.best(tokens)) == max(ways, key=ways.get)
        by_segment, _ = field.gradient(window, {})
        log_total = np.logaddexp.reduce(list(ways.values()))
        for s, (i, j) in enumerate(window.segments):
            for k in range(len(pii.KINDS)):
                mass = sum(np.exp(v - log_total) for made, v in ways.items() if (i, k, j) in made)
                assert abs(-by_segment[s, k] - mass) < 1e-6


def plain_program(field, window):
    """The program over all segments listed at once."""
    n, labels = len(window.bounds), len(pii.KINDS) + 1
    value, back, scores = np.full((n + 1, labels), -np.inf), {}, field.scores(window)
    value[0, 0] = 0.0
    for t in range(1, n + 1):
        for s, (i, j) in [(None, (t - 1, t)), *((s, x) for s, x in enumerate(window.segments) if x[1] == t)]:
            for k in range(labels) if s is not None else [0]:
                if (k == 0) != (s is None):
                    continue
                ways = value[i] + field.follows[:, k] + (scores[s, k - 1] if k else 0)
                if ways.max() > value[t, k]:
                    value[t, k], back[t, k] = ways.max(), (i, int(ways.argmax()))
    out, t, k = [], n, int(value[n].argmax())
    while t:
        i, p = back[t, k]
        out += [(i, k - 1, t)] if k else []
        t, k = i, p
    return out[::-1]


def test_program_in_blocks_equals_the_plain_one(monkeypatch):
    """Blocks of starts, many windows at once, and segments that end in a later block change nothing."""
    choice, rng = np.random.default_rng(8), random.Random(8)
    field = pii.Field(choice.normal(size=(len(pii.KINDS), pii.FEATURES)), choice.normal(size=(5, 5)))
    parts = ["1", "22", "4111", " ", " ", ".", "-", "at", "dot", "ab", "@", "(", "]", "x7", "\n", "é", "+", "10.0.0.1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    want = []
    for w, text in enumerate(texts):
        window = pii.read_window(text, 0, len(text))
        want += [(w, text[window.bounds[i][0] : window.bounds[j - 1][1]], k) for i, k, j in plain_program(field, window)]
    for block in (7, 4096):
        monkeypatch.setattr(pii, "BLOCK", block)
        tokens = pii.Tokens([(t, 0, len(t)) for t in texts])
        got = [(tokens.window[i], texts[tokens.window[i]][tokens.bounds[i][0] : tokens.bounds[j - 1][1]], k) for i, k, j in field.best(tokens)]
        assert got == want


@pytest.mark.parametrize("make", ["digits", "dots", "both", "ats", "table"])
def test_personal_data_takes_proportional_time_and_memory(make):
    unit = {
        "digits": "7 " * 500,
        "dots": "ab dot " * 143,
        "both": "7 dot 8 at ab dot " * 56,
        "ats": ("ab dot " * 60 + "at ") * 2,
        "table": "| 12.50 | 2024-01-02 | (3) 55 |\n" * 31,
    }[make]
    choice = np.random.default_rng(9)
    field = pii.Field(choice.normal(size=(len(pii.KINDS), pii.FEATURES)) - 0.5, choice.normal(size=(5, 5)))
    costs = []
    for kb in (20, 40, 80):
        text = (unit * (kb * 1000 // len(unit) + 1))[: kb * 1000]
        begin = time.process_time()
        pii.added_spans(text, pii.base_spans(text), field)
        costs.append(time.process_time() - begin)
    assert costs[2] < 6 * costs[0] + 1, costs  # in proportion it would be 4
    peaks = []
    for kb in (4, 16):
        text = (unit * (kb * 1000 // len(unit) + 1))[: kb * 1000]
        tracemalloc.start()
        pii.added_spans(text, pii.base_spans(text), field)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 6 * peaks[0] + (1 << 20), peaks


def test_personal_data_on_odd_rows(spark):
    docs, field = documents(spark), trained()
    got = {(r["doc_id"], r["base_sha256"], r["n_email"]) for r in pii.find(docs, field).collect()}
    want = {
        (i, hashlib.sha256(pii.written(brute_spans(t or "")).encode()).hexdigest(), sum(k == 0 for _, k, _ in brute_spans(t or "")))
        for i, t, _ in texts()
        if i not in (9, 15)  # plain patterns take quadratic time there
    }
    assert want <= got and len(got) == len(want) + 2
    masked = pii.mask(docs, field)
    assert masked.schema == docs.schema and masked.count() == docs.count()
    text = masked.filter("doc_id = 13").first()["text"]
    assert text == "mail <EMAIL> or <PHONE> or <CARD> at <IP>"
    assert pii.find(no_documents(spark), pii.train(no_documents(spark))).count() == 0


# --- 3, near duplicates


def brute_components(rows, width, percent):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
        grams = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets.append(grams)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sets, [least.get(find(i), rows[i][0]) for i in range(len(rows))]


@pytest.mark.parametrize(("width", "percent"), [(4, 80), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, width, percent):
    choice, rows = random.Random(width), texts()
    base = [f"w{i}" for i in range(150)]
    for i in range(100, 160):  # copies with more and more changes, and a shared passage
        words = list(base) if i < 140 else [f"u{i}x{k}" for k in range(70)] + base[:60]
        for _ in range(choice.randint(0, 6)):
            words[choice.randrange(len(words))] = f"z{choice.randrange(40)}"
        rows.append((i, " ".join(words), "n"))
    # Rows without an id link others, and each other; rows of one id with texts of their own.
    lone = [f"lone{k}" for k in range(80)]
    rows += [(None, " ".join(base), "n"), (None, " ".join(lone), "n"), (None, " ".join([*lone, "more"]), "n")]
    rows += [(300, " ".join(lone[::-1]), "n"), (300, " ".join([*lone[::-1], "end"]), "n"), (300, " ".join(lone[::3] * 2), "n")]
    sets, want = brute_components(rows, width, percent)
    got = rows_of(neardup.near_duplicates(documents(spark, rows), width, percent))
    expected = sorted(
        ((i, len(s), c, i is None or i == c) for (i, _, _), s, c in zip(rows, sets, want)), key=repr
    )
    assert got == expected


def test_only_blocks_of_strays_are_paired(spark):
    """Blocks of a component do not meet each other, and every block of strays meets all others once."""
    blocks = [(1, 0, i) for i in range(40)] + [(1, 1, 100), (1, 1, 101)] + [(2, 0, 200), (3, 1, 300)]
    table = spark.createDataFrame(blocks, "main bigint, stray bigint, block bigint")
    got = sorted(map(tuple, neardup.block_pairs(table).collect()))
    want = [(a, b) for m, s, a in blocks for n, t, b in blocks if m == n and s and (not t or a <= b)]
    assert got == sorted(want)
    assert len(got) == 2 * 40 + 3 + 1


def test_strays_are_found_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 3)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 200)
    choice = random.Random(3)
    sets = {i: sorted(choice.sample(range(60), 40)) for i in range(60)}
    table = spark.createDataFrame(list(sets.items()), "id bigint, shingles array<bigint>")
    labels = spark.createDataFrame([(i, 0) for i in range(40)], "node bigint, component bigint")
    strays = spark.createDataFrame([(0, i) for i in range(40, 60)], "main bigint, id bigint")
    found = neardup._stray_links(strays, labels, table, 60)
    root = {i: 0 if i < 40 else i for i in sets}

    def joined(root, edges):
        root = dict(root)
        for a, b in edges:
            a, b = sorted((root[a], root[b]))
            root = {k: a if v == b else v for k, v in root.items()}
        return root

    def similar(a, b):
        both = len(set(sets[a]) & set(sets[b]))
        return 100 * both >= 60 * (80 - both)

    links = [(a, b) for a in sets for b in range(40, 60) if a != b and similar(a, b)]
    got = [tuple(r) for r in found.collect()]
    assert joined(root, got) == joined(root, links)


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(no_documents(spark)).count() == 0


def test_components_equal_brute_force(spark):
    choice = random.Random(9)
    edges = [(choice.randrange(300), choice.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1200)]
    edges += [(i, i + 1) for i in range(2000, 2040)] + [(5, 5)]
    root = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = rows_of(components.components(spark.createDataFrame(edges, "a bigint, b bigint")))
    assert got == sorted(((x, find(x)) for x in root), key=repr)


# --- 4 and 8, tokens


def test_word_encoder_equals_tokenizer():
    choice = random.Random(1)
    signs = ["a", "B", "é", "é", "İ", "Σ", "ς", "1", "٣", ".", ",", "'s", "'LL", " ", "\n", "\u00a0", "\u2003", "<|endoftext|>", "<|", "ß", "中", "ᄒ", "ᅡ", "\x1c", "\x85", "😀", "²", "Ⅷ"]
    encoder = WordEncoder(tokenizer_file(), 2, limit=60)
    for _ in range(100):
        some = ["".join(choice.choice(signs) for _ in range(choice.randint(0, 30))) for _ in range(20)]
        ids, sizes = encoder.encode([x.encode() for x in some])
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [x + [2] for x in plain_ids(some)]


def test_new_words_seldom_pass_the_whole_tokenizer(monkeypatch):
    """Words of a to z need no normaliser, and what ends a word is a word that is known already."""
    choice = random.Random(7)
    words = ["".join(choice.choice("abcdefghij") for _ in range(choice.randint(3, 9))) for _ in range(600)]
    ends = ["", ".", ".***", ",%%%", "!!", "\"]&~"]
    some = [w + choice.choice(ends) for w in words] + ["we're", "'s.", "x'll!!", "o'clock,", "été.###", "1.&&&", "[a]"]
    encoder, passed = WordEncoder(tokenizer_file(), 2), []
    whole = encoder._plain
    monkeypatch.setattr(encoder, "_plain", lambda texts: passed.extend(texts) or whole(texts))
    ids, sizes = encoder.encode([x.encode() for x in some])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [x + [2] for x in plain_ids(some)]
    assert len(passed) < 20


def test_words_are_cut_where_pieces_end():
    """Signs, apostrophes, marks and letters of all kinds beside each other, in small and large slices."""
    choice = random.Random(8)
    signs = [*"ab.-<=>_[&#'0", "'s", "'ll", "A", "É", "é", "ñ", "ß", "ſ", "ɐ", "ш", "\u0338", "\u0301", "\u00a0", "\x1f", "…", "|", " ", "\t"]
    encoder = WordEncoder(tokenizer_file(), 2)
    some = ["".join(choice.choice(signs) for _ in range(choice.randint(0, 25))) for _ in range(3000)] + ["", " "]
    want = [x + [2] for x in plain_ids(some)]
    for size in (1, 7, len(some)):
        got = []
        for i in range(0, len(some), size):
            ids, sizes = encoder.encode([x.encode() for x in some[i : i + size]])
            got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == want
    assert [len(x) for x in encoder.encode([])] == [0, 0]


def test_words_are_looked_up_once_for_many_texts():
    """What repeats costs no lookup, and what is made of words and signs that are known is not encoded."""
    encoder, looked = WordEncoder(tokenizer_file(), 2), []

    class Counted(type(encoder.memory.numbers)):
        def __getitem__(self, word):
            looked.append(word)
            return super().__getitem__(word)

    numbers = Counted({}, encoder.memory.numbers.count)
    numbers.update(encoder.memory.numbers)
    encoder.memory.numbers = numbers
    some = ["One two, three-one. (two) " * 500, "three two "] * 20
    ids, sizes = encoder.encode([x.encode() for x in some])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [x + [2] for x in plain_ids(some)]
    assert len(looked) < 20


def test_new_words_with_accents_seldom_pass_the_whole_tokenizer(monkeypatch):
    choice = random.Random(9)
    some = ["".join(choice.choice("abéèçñöß") for _ in range(choice.randint(3, 9))) for _ in range(600)] + ["É", "шш"]
    encoder, passed = WordEncoder(tokenizer_file(), 2), []
    whole = encoder._plain
    monkeypatch.setattr(encoder, "_plain", lambda texts: passed.extend(" ".join(texts).split()) or whole(texts))
    ids, sizes = encoder.encode([x.encode() for x in some])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [x + [2] for x in plain_ids(some)]
    assert len(passed) < 20


def test_word_memory_keeps_what_is_in_use():
    """Words seen in every generation are learned once; memory stays bounded; ids stay right."""
    memory, learned = WordMemory([""], [[9]], limit=50), Counter()
    choice = random.Random(6)
    for step in range(200):
        memory.make_room()
        words = ["often", "common", *(f"w{choice.randint(0, 10**6)}" for _ in range(20)), ""]
        pick = np.array([memory.numbers[w] for w in words])
        new = memory.numbers.new
        learned.update(new)
        own = [[len(w), *w.encode()] for w in new]
        memory.learn(np.array([x for o in own for x in o], np.uint32), np.array([len(o) for o in own], np.int64))
        ids, sizes = memory.gather(pick)
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [[9] if w == "" else [len(w), *w.encode()] for w in words]
        assert len(memory.numbers) + len(memory.numbers.old) <= 2 * 50 + 60
    assert learned["often"] == learned["common"] == 1


def test_word_memory_holds_a_word_once():
    """A word that comes again moves to the young generation, and ids take no more bytes than they need."""
    memory, words = WordMemory([b""], [[9]], limit=1000, top=49_151), [b"w%d" % i for i in range(1200)]
    for _ in range(3):
        memory.make_room()
        pick = np.array([memory.numbers[w] for w in words])
        new = memory.numbers.new
        memory.learn(np.array([int(w[1:]) for w in new], np.uint32), np.ones(len(new), np.int64))
        assert memory.gather(pick)[0].tolist() == list(range(1200))
        assert not memory.numbers.keys() & memory.numbers.old.keys() - {b""}
    assert memory.ids.dtype == np.uint16 and memory.gather(pick)[0].dtype == np.uint32


def test_new_words_are_encoded_some_at_a_time(monkeypatch):
    encoder, most = WordEncoder(tokenizer_file(), 2), []
    bare = encoder._bare
    monkeypatch.setattr(encoder, "_bare", lambda texts: most.append(len(texts)) or bare(texts))
    words = ["".join(x) for x in itertools.product("abcdefghijklmnop", repeat=4)][:20_000]
    ids, _ = encoder.encode([" ".join(words).encode()])
    assert ids.tolist() == plain_ids([" ".join(words)])[0] + [2]
    assert max(most) <= 64 and sum(most) == -(-len(words) // 64)


def test_words_of_digits_are_encoded_some_at_a_time(monkeypatch):
    encoder, most = WordEncoder(tokenizer_file(), 2), []
    whole = encoder._plain
    monkeypatch.setattr(encoder, "_plain", lambda texts: most.append(len(texts)) or whole(texts))
    text = " ".join(map(str, range(20_000)))
    ids, _ = encoder.encode([text.encode()])
    assert ids.tolist() == plain_ids([text])[0] + [2]
    assert max(most) <= 4096 and sum(most) == 20_000


def test_classifier_is_fitted_in_little_more_than_its_rows():
    choice = np.random.default_rng(3)
    rows = [np.sort(choice.choice(quality.SIZE, 2000, replace=False)).astype(np.int32) for _ in range(2000)]
    good = np.arange(2000) % 2 == 0
    tracemalloc.start()
    quality.descend(rows, np.where(good, 1.0, -1.0), quality.log_count_ratios(rows, good))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 20 << 20 < sum(8 * len(r) for r in rows)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, tmp_path):
    rows = [r for r in texts() if r[0] != 9]
    tokenfiles.write_tokens(documents(spark, rows), str(tmp_path / "t"), tokenizer_file(), 2)
    got = [tuple(r) for r in tokenfiles.read_checksums(spark, str(tmp_path / "t")).orderBy("start").collect()]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at, want = 0, []
    for (key, _, _), ids in zip(order, plain_ids([t or "" for _, t, _ in order]), strict=True):
        want.append((key, at, len(ids) + 1, crc([*ids, 2])))
        at += len(ids) + 1
    assert got == want
    read = tokenfiles.read_tokens(spark, str(tmp_path / "t")).filter("doc_id = 7").first()
    assert read["ids"] == [*plain_ids(["one two"])[0], 2]
    tokenfiles.write_tokens(no_documents(spark), str(tmp_path / "none"), tokenizer_file(), 2)
    assert tokenfiles.read_checksums(spark, str(tmp_path / "none")).count() == 0


def test_token_files_split_a_hot_id(spark, tmp_path):
    """Rows of one id, or none, spread over files, and stay in order."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(5, f"a common beginning of all these texts {i % 7}", "s") for i in range(400)] + [(None, "same", "s")] * 400
        tokenfiles.write_tokens(documents(spark, rows), str(tmp_path / "t"), tokenizer_file(), 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(tokenfiles.F.col("_metadata.file_name")).count()
    assert files.agg({"count": "max"}).first()[0] < 400
    got = [tuple(r) for r in tokenfiles.read_checksums(spark, str(tmp_path / "t")).orderBy("start").collect()]
    assert [g[0] for g in got] == [None] * 400 + [5] * 400
    ends = [g[1] + g[2] for g in got]
    assert [g[1] for g in got] == [0, *ends[:-1]]
    want = [crc([*ids, 2]) for ids in plain_ids([t for _, t, _ in rows])]
    assert sorted(g[3] for g in got) == sorted(want)


def test_token_files_of_several_files_a_task(spark, tmp_path):
    rows = [(i, "one two three " * (i % 5), "s") for i in range(200)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        tokenfiles.write_tokens(documents(spark, rows), str(tmp_path / "t"), tokenizer_file(), 2)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    got = [tuple(r) for r in tokenfiles.read_checksums(spark, str(tmp_path / "t")).orderBy("doc_id").collect()]
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n


def test_token_files_are_encoded_as_said(spark, tmp_path):
    import pyarrow.parquet as pq

    tokenfiles.write_tokens(documents(spark), str(tmp_path / "t"), tokenizer_file(), 2)
    file = next(p for p in (tmp_path / "t").glob("*.parquet") if pq.ParquetFile(p).metadata.num_rows)
    columns = {c.path_in_schema: c for c in (pq.ParquetFile(file).metadata.row_group(0).column(i) for i in range(4))}
    assert "DELTA_BINARY_PACKED" in columns["file_start"].encodings
    assert columns["ids.list.element"].has_dictionary_page
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())


def check_packing(rows, placed, capacity):
    ids = Counter()
    want = {}
    for (key, text, _), own in zip(rows, plain_ids([t or "" for _, t, _ in rows]), strict=True):
        ids[key, len(own) + 1] += 1
        want[key, len(own) + 1] = [*own, 1]
    pieces = defaultdict(list)
    for doc, start, length, crc32, total, _, _ in placed:
        assert crc(want[doc, total][start : start + length]) == crc32
        pieces[doc, total].append((start, length))
    for key, own in pieces.items():
        cover = Counter(i for start, length in own for i in range(start, start + length))
        assert set(cover.values()) == {ids[key]} and len(cover) == key[1]
    assert set(pieces) == set(want)
    sequences = defaultdict(list)
    for row in placed:
        sequences[row[5]].append((row[6], row[2]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_places_every_id_once_without_padding(spark, capacity):
    rows = [r for r in texts() if r[0] not in (9, 15)]
    placed, _ = packing.pack(documents(spark, rows), tokenizer_file(), 1, capacity)
    check_packing(rows, [tuple(r) for r in placed.collect()], capacity)


def test_packing_of_one_length(spark):
    """Pieces that no multiset fits together are cut."""
    rows = [(i, "a " * 36, "s") for i in range(50)]
    placed, _ = packing.pack(documents(spark, rows), tokenizer_file(), 1, 64)
    check_packing(rows, [tuple(r) for r in placed.collect()], 64)
    placed, _ = packing.pack(no_documents(spark), tokenizer_file(), 1, 64)
    assert placed.count() == 0


def test_fill_equals_enumeration():
    choice = random.Random(3)
    for _ in range(300):
        stock = {choice.randint(1, 30): choice.randint(1, 3) for _ in range(choice.randint(1, 5))}
        capacity = choice.randint(30, 60)
        total, taken = packing.fill(stock, capacity)
        longest = max(stock)
        sums = {longest}
        for length, many in stock.items():
            left = many - (length == longest)
            sums = {s + k * length for s in sums for k in range(left + 1)}
        assert total == max(s for s in sums if s <= capacity)
        assert total == sum(k * n for k, n in taken.items())
        assert all(n <= stock[k] for k, n in taken.items()) and taken[longest] >= 1


# --- 7, mixing


def test_mix_equals_brute_force(spark):
    rows = texts()
    got = mixing.mix(documents(spark)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = dict(zip(names, [5, 2, 1] * len(names)))
    free, target, left = set(names), {}, 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weights[s] for s in free)
        full = {s for s in free if 2 * sizes[s] <= level * weights[s]}
        if not full:
            target |= {s: level * weights[s] for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2.0 * sizes[s] for s in full)
        free -= full
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in names)
    assert rows_of(mixing.mix(documents(spark))) == sorted((tuple(r) for r in got), key=repr)
    drawn = mixing.drawn(documents(spark), mixing.mix(documents(spark)))
    assert drawn.schema.names == documents(spark).schema.names
    words = Counter()
    for r in drawn.collect():
        words[r["source"]] += size(r["text"])
    assert words == +taken
    assert mixing.mix(no_documents(spark)).count() == 0


def test_positions_follow_the_ramp(spark):
    """Half of a target with slope 0.5 is due at the time where its integral is one half."""
    for slope in (-0.5, 0.0, 0.5):
        for done in (0.0, 0.25, 0.5, 1.0):
            t = spark.range(1).select(mixing._position(mixing.F.lit(done), mixing.F.lit(slope))).first()[0]
            assert abs(t + slope * (t * t - t) - done) < 1e-9


# --- 9, repeated strings


def brute_repeats(rows, length=200):
    data = [(i, (t or "").encode()) for i, t, _ in rows]
    seen = Counter(t[p : p + length] for _, t in data for p in range(len(t) - length + 1))
    out = []
    for key, t in data:
        cover = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                cover[p : p + length] = b"\1" * length
        runs = sum(c and (i == 0 or not cover[i - 1]) for i, c in enumerate(cover))
        kept = bytes(c for c, gone in zip(t, cover) if not gone)
        out.append((key, len(t), len(t) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [repeats.MOST_CONTEXTS, 2])
def test_repeats_equal_brute_force(spark, most):
    choice = random.Random(1)
    rows = [r if r[0] not in (9, 10, 15) else (r[0], (r[1] or "")[:1500], r[2]) for r in texts()]
    base = "".join(choice.choice("abc é") for _ in range(600))
    for k in range(40):
        a = choice.randint(0, 500)
        rows.append((100 + k, "".join(choice.choice("xyz") for _ in range(choice.randint(0, 30))) + base[a : choice.randint(a, 600)] + "".join(choice.choice("xy") for _ in range(choice.randint(0, 99))), "r"))
    got = rows_of(repeats.remove_repeats(documents(spark, rows), most_contexts=most))
    assert got == brute_repeats(rows)


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(no_documents(spark)).count() == 0


def test_suffix_array_equals_sorting():
    choice = random.Random(3)
    for _ in range(800):
        text = [choice.randint(1, choice.randint(1, 4)) for _ in range(choice.randint(0, 40))] + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    for text in ([1] * 300 + [0], [1, 2] * 100 + [0], [3, 2, 1] * 70 + [0]):
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
