"""Exact top-k by inner product with block-at-a-time pruning.

Vectors become integers, `floor(64 * x)`. Rows are cut into ranges, a range into blocks; a block has a
forward index, the matrix of its rows, and for each term (component) its largest and smallest value.
What a query can score in a block is at most the sum over terms of its weight times the larger end
for a positive weight, times the smaller end for a negative one. For each chunk of queries and each
range, blocks are taken in descending order of that bound, queries whose bound lies under their k-th
score leave, and the rest is scored through the forward index. A query's k best of each range meet in
a last ranking, which sees k rows per query and range. Bounds only skip what cannot enter, so results
are exact; a bound equal to the k-th score is still looked at, for the tie may go to a smaller id.

Queries and rows travel in packed blocks; nothing is broadcast and no pair of rows is a row.

Null vectors and those with null or non-finite components take no part, as query or candidate; where
lengths differ, only vectors of the query's length are candidates; repeated vectors tie and the
smaller id comes first; a row with a null id is no query and no candidate; an empty table gives no
rows; other columns are not read. Equal rows of one id are one query, and candidates each. Numbers too large for exact arithmetic in doubles are summed as
Python integers; a score beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedkit.llm.vectors import matrix_of, paired, regrouped, usable
from feedkit.plans.settle import settle

SCALE = 64.0
#: Rows of a block, blocks of a range, and queries of a chunk.
BLOCK_ROWS, RANGE_ROWS, CHUNK_ROWS = 256, 8192, 512
PACKED = "block bigint, dim int, ids binary, cells binary"
FOUND = "query_id bigint, vec_id bigint, score bigint"


def _packer(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in regrouped(batches, 2, lambda _: most):
            cells = matrix_of(table.column(3).combine_chunks())
            yield pa.RecordBatch.from_arrays(
                [
                    table.column(1).slice(0, 1).combine_chunks(),
                    table.column(0).slice(0, 1).combine_chunks(),
                    pa.array([table.column(2).to_numpy().astype("<i8").tobytes()], pa.binary()),
                    pa.array([cells.astype("<f8").tobytes()], pa.binary()),
                ],
                names=["block", "dim", "ids", "cells"],
            )

    return run


def _pack(rows: DataFrame, count: int, most: int) -> DataFrame:
    """Rows (id, dim, cells) in blocks of about `most`, dealt by a hash of the id."""
    blocks = max(1, -(-count // most))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", F.lit(11)), F.lit(blocks)))
    dealt = dealt.select("dim", "block", "id", "cells")
    dealt = dealt.repartition("dim", "block").sortWithinPartitions("dim", "block", "id")
    packed = dealt.mapInArrow(_packer(2 * most), PACKED)
    # A block that came out too large was cut: number blocks by what they hold.
    return settle(packed.withColumn("block", F.xxhash64("dim", "ids")), "blocks")


def _dots(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products as int64."""
    reach = max(np.abs(queries).max(initial=0), 1) * max(np.abs(rows).max(initial=0), 1) * max(rows.shape[1], 1)
    if reach < 2**24:
        return (queries.astype(np.float32) @ rows.astype(np.float32).T).astype(np.int64)
    if reach < 2**53:
        return (queries @ rows.T).astype(np.int64)
    as_int = np.vectorize(int, otypes=[object])
    return (as_int(queries) @ as_int(rows).T).astype(np.int64)


def best_rows(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ids and scores of its k best rows; absent ones have the largest id."""
    none, low = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    best_ids = np.full((len(queries), k), none)
    best = np.full((len(queries), k), low)
    # Ranges are cut into blocks by their strongest term, so that bounds differ.
    order = np.lexsort((rows.max(axis=1), rows.argmax(axis=1))) if rows.shape[1] else np.arange(len(rows))
    cuts = [order[i : i + BLOCK_ROWS] for i in range(0, len(order), BLOCK_ROWS)]
    if rows.shape[1]:
        tops = np.stack([rows[c].max(axis=0) for c in cuts])
        ends = np.stack([rows[c].min(axis=0) for c in cuts])
    else:
        tops = ends = np.zeros((len(cuts), 0))
    bounds = np.maximum(queries, 0) @ tops.T + np.minimum(queries, 0) @ ends.T
    bounds += np.abs(bounds) * 1e-9  # what rounding can take from sums beyond 2**53
    for b in np.argsort(-bounds.max(axis=0, initial=-np.inf), kind="stable"):
        active = np.flatnonzero((bounds[:, b] >= best[:, -1]) | (best_ids[:, -1] == none))
        if not len(active):
            continue
        own = np.sort(cuts[b])
        scores = _dots(queries[active], rows[own])
        names = np.broadcast_to(ids[own], scores.shape)
        other = names != query_ids[active][:, None]
        floor = best[active, -1][:, None]
        hit = other & ((scores > floor) | (scores == floor) | (best_ids[active, -1] == none)[:, None])
        some = np.flatnonzero(hit.any(axis=1))
        for i in some:
            q, mine = active[i], hit[i]
            both_ids = np.concatenate([best_ids[q], names[i, mine]])
            both = np.concatenate([best[q], scores[i, mine]])
            top = np.lexsort((both_ids, -both.astype(np.float64))) if np.abs(both[both > low]).max(initial=0) < 2**53 else np.array(sorted(range(len(both)), key=lambda x: (-int(both[x]), both_ids[x])))
            best_ids[q], best[q] = both_ids[top[:k]], both[top[:k]]
    return best_ids, best


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                query_ids, ids = np.frombuffer(one["ids"], "<i8"), np.frombuffer(two["ids"], "<i8")
                queries = np.frombuffer(one["cells"], "<f8").reshape(len(query_ids), -1)
                rows = np.frombuffer(two["cells"], "<f8").reshape(len(ids), -1)
                found, scores = best_rows(query_ids, queries, ids, rows, k)
                real = found != np.iinfo(np.int64).max
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.broadcast_to(query_ids[:, None], found.shape)[real], pa.int64()),
                        pa.array(found[real], pa.int64()),
                        pa.array(scores[real], pa.int64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def top_k(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: `vectors` has vec_id and embedding.

    `is_query` is a condition on vec_id that chooses the queries.
    """
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("id"), vector.alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    # Doubles hold these integers exactly as far as the inputs do.
    cells = F.transform("v", lambda x: _floor(x * SCALE))
    rows = rows.select("id", F.size("v").alias("dim"), cells.alias("cells"))
    asked = rows.filter(is_query(F.col("id"))).distinct()
    counts = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query(F.col("id")), 1))).first()
    ranges = _pack(rows, counts[0], RANGE_ROWS)
    chunks = _pack(asked, counts[1], CHUNK_ROWS)
    pairs = chunks.select("dim", F.col("block").alias("a")).join(
        ranges.select("dim", F.col("block").alias("b")), "dim"
    )
    found = paired(pairs.select("a", "b"), chunks, ranges).mapInArrow(_search(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _floor(x):
    """Floor as a double; `floor` itself gives a bigint, which large numbers overflow."""
    down = F.rint(x)
    return F.when(down > x, down - 1).otherwise(down)
