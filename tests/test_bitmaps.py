"""Bitmaps of pieces: merged ones tell what all fragments at once do."""

from __future__ import annotations

import random

import pytest
from helpers import tuples

from feedkit.operators import bitmaps as bm
from feedkit.operators import fragments as fr
from feedkit.plans.settle import settle

SCHEMA = "identifier string, idx bigint, cnt bigint, arrival bigint"


def odd_rows():
    choice, rows = random.Random(3), []
    edge = bm.CHUNK
    for name, cnt, lost in (
        ("whole", 3, ()), ("edge", edge, (1, edge)), ("over", edge + 1, (edge, edge + 1)), ("far", 5 * edge + 7, range(edge // 2, 4 * edge)),
        ("tail", 3 * edge, range(edge + 5, 3 * edge + 1)), ("head", 2 * edge + 9, range(1, 2 * edge)),
    ):
        gone = set(lost)
        rows += [(name, i, cnt, choice.randint(1, 99)) for i in range(1, cnt + 1) if i not in gone and (cnt < 9 or i in (1, edge, edge + 1, cnt) or choice.random() < 0.02)]
    rows += [("stray", i, 3, i) for i in (1, 2, 3)] + [("stray", i, 10**6, 90 + i) for i in (1, 70_000, 999_999)]
    rows += [("huge", 2**40, 2**41, 1), (None, 1, 2, 1), ("no", 1, 1, 1), ("no", 5, 2, 1), ("no", None, 2, 1), ("no", 1, None, 1), ("late", 1, 2, None), ("late", 2, 2, 5)]
    rows += choice.sample(rows, 50)
    choice.shuffle(rows)
    return rows


@pytest.mark.parametrize("days", [1, 2, 5])
def test_merged_bitmaps_equal_one_pass(spark, days):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    parts = [settle(bm.piece_bitmaps(spark.createDataFrame(rows[i::days], SCHEMA)), "day") for i in range(days)]
    merged = bm.merge_bitmaps(*parts)
    assert tuples(bm.bitmap_status(merged), "identifier", "seen", "cnt", "state") == tuples(fr.fragment_status(df), "identifier", "seen", "cnt", "state")
    assert tuples(bm.bitmap_gaps(merged), "identifier", "from_n", "to_n") == tuples(fr.missing_ranges(df), "identifier", "from_n", "to_n")


def test_what_moves_is_a_row_for_each_chunk(spark):
    rows = spark.range(0, 200_000, 1, 6).selectExpr("'f' AS identifier", "id + 1 AS idx", "200000L AS cnt", "id AS arrival")
    got = bm.piece_bitmaps(rows)
    assert got.count() == 7
    assert tuples(bm.bitmap_status(got), "seen", "state") == [(200_000, "complete")]
    assert bm.bitmap_gaps(got).count() == 0 and bm.piece_bitmaps(rows.limit(0)).count() == 0
