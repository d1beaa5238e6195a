"""Small tables with everything that is odd: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
#: Extra columns whose names operators might use themselves.
CLASHING = "id int, n int, size int, hash string, block int, target string, positions string, taken int, kept string"
CLASHING_VALUES = (None, 1, 2, "h", 3, "t", "p", 4, "k")
DOCS = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source) rows."""
    choice = random.Random(4)
    story = " ".join(choice.choice(WORDS) + str(i % 17) for i in range(120))
    near = story.replace(" beta", " BETA").replace("iota3", "changed", 1)
    rows: list[tuple[int | None, str | None, str | None]] = [
        (1, story, "a"),
        (2, story, "a"),
        (3, near, "b"),
        (4, None, "a"),
        (5, "", None),
        (6, " \t\n ", ""),
        (7, "one two", "a"),
        (8, "one two", "z"),
        (8, "one two", "z"),
        (None, "no id at all", "a"),
        (9, "x" * 300_000, "b"),
        (10, "word " * 60_000, "b"),
        (11, story + " and more " + story, None),
        (12, "é" * 250 + "\0" * 250, "c"),
        (13, "mail me.now@host.example.org or +1 (017) 555-7713 or 4111 1111 1111 1111 at 10.0.0.255", "c"),
        (14, "<|endoftext|> and <|startoftext|>", "c"),
        (15, "1" * 50_000 + "+" * 50_000 + "@" * 50_000 + "a" * 50_000, "c"),
    ]
    for i in range(20, 60):
        rows.append((i, " ".join(choice.choice(WORDS) + choice.choice("abcdef") for _ in range(choice.randint(1, 90))), choice.choice("abc")))
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, None, s, len(t or ""), *CLASHING_VALUES) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)
