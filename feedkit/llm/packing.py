"""Packing of tokenized documents into fixed windows by minimum bin slack.

Each document's ids are cut at multiples of the capacity; full windows stand alone, and the pieces
left over are packed. What the packer needs of them is their stock: how many there are of each
length, at most `capacity` numbers however many documents there are. For each window a subset-sum
dynamic program over the bits of an integer, started from the longest length in stock, finds the
multiset of lengths that fills it closest to capacity, and walks back to how many of each it takes;
the window is repeated while the stock lasts. If no multiset fills a window to the last token, the
pieces of its longest length are laid end to end and cut at the window's end instead; the tail of
that stream is cut into powers of two. So no sequence needs padding.

Pieces take their places by rank within their length. The rank comes from counts per task that wrote
them, so no length, however common, meets in one task.

Null texts count as empty and hold the end id alone; every repeated row is packed; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedkit.llm.wordids import encoder, spans
from feedkit.plans.settle import settle

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "part int, pos bigint, nth bigint, ids binary"
)
OUT = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)
COLUMNS = [c.split()[0] for c in OUT.split(", ")]


def cut(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keep_ids: bool = False
) -> DataFrame:
    """PIECES rows: the ids of every document cut at multiples of `capacity`.

    `part`, `pos` and `nth` number a piece by task, within it, and within it among its length. `ids`
    (little-endian, 32 bits) is kept for pieces below capacity, which may be cut again, or for all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer, end_id)
        part, pos, seen = TaskContext.get().partitionId(), 0, [0] * (capacity + 1)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for own in spans(pc.binary_length(texts).to_pylist()):
                ids, sizes = words.encode(texts[own].to_pylist())
                ids = ids.astype("<u4", copy=False)
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
                length = np.minimum(sizes[row] - start, capacity)
                begin = (np.cumsum(sizes) - sizes)[row] + start
                raw = [ids[b : b + n].tobytes() for b, n in zip(begin, length, strict=True)]
                nth = []
                for n in length.tolist():
                    nth.append(seen[n])
                    seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(own.start, own.stop - own.start).take(pa.array(row)),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                        pa.array(sizes[row], pa.int64()),
                        pa.array(np.full(len(row), part), pa.int32()),
                        pa.array(np.arange(pos, pos + len(row)), pa.int64()),
                        pa.array(nth, pa.int64()),
                        pa.array(
                            [x if keep_ids or len(x) < 4 * capacity else None for x in raw], pa.binary()
                        ),
                    ],
                    names=[c.split()[0] for c in PIECES.split(", ")],
                )
                pos += len(row)

    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("bigint"), whole).mapInArrow(run, PIECES)


def fill(stock: dict[int, int], capacity: int) -> tuple[int, dict[int, int]]:
    """The multiset with the least slack that holds the longest length in stock.

    Bit s of `reach` says that a multiset of the lengths so far sums to s. A length with count c goes
    in as 1, 2, 4, ... of it, and the layers are walked back to the counts taken.
    """
    longest = max(stock)
    goal = capacity - longest
    mask, reach = (1 << (goal + 1)) - 1, 1
    layers: list[tuple[int, int, int]] = []
    for length in sorted(stock, reverse=True):
        if length > goal:
            if length != longest:
                continue
        left = min(stock[length] - (length == longest), goal // length)
        many = 1
        while left > 0:
            many = min(many, left)
            layers.append((length, many, reach))
            reach |= (reach << (length * many)) & mask
            left, many = left - many, many * 2
        if reach >> goal & 1:
            break
    total = at = reach.bit_length() - 1
    taken = {longest: 1}
    for length, many, before in reversed(layers):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + many
            at -= length * many
    return longest + total, taken


@dataclass
class Plan:
    """Where the pieces of each length go, by rank."""

    capacity: int
    #: length, first rank, how many a window takes, first window, first offset
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    #: From which rank on a length's pieces lie in the stream, and where the stream has them.
    stream_from: dict[int, int] = field(default_factory=dict)
    stream_at: dict[int, int] = field(default_factory=dict)
    stream_window: int = 0
    stream_tokens: int = 0

    def edges(self) -> tuple[int, list[int]]:
        """Stream positions up to which there are whole windows, and where the others end."""
        at = whole = self.stream_tokens // self.capacity * self.capacity
        ends, left = [], self.stream_tokens - whole
        for bit in reversed(range(left.bit_length())):
            if left >> bit & 1:
                at += 1 << bit
                ends.append(at)
        return whole, ends


def plan_windows(stock: dict[int, int], capacity: int) -> Plan:
    """Windows for the whole stock: full pieces, exact fills, and a stream of what is left."""
    plan, stock, window = Plan(capacity), {k: n for k, n in stock.items() if n}, 0
    used = dict.fromkeys(stock, 0)
    if capacity in stock:
        window = stock.pop(capacity)
        plan.runs.append((capacity, 0, 1, 0, 0))
    while stock:
        total, taken = fill(stock, capacity)
        if total < capacity:
            longest = max(stock)
            plan.stream_from[longest] = used[longest]
            plan.stream_at[longest] = plan.stream_tokens
            plan.stream_tokens += longest * stock.pop(longest)
            continue
        times = min(stock[k] // n for k, n in taken.items())
        offset = 0
        for length, many in taken.items():
            plan.runs.append((length, used[length], many, window, offset))
            offset += length * many
            used[length] += many * times
            stock[length] -= many * times
            if not stock[length]:
                del stock[length]
        window += times
    plan.stream_window = window
    return plan


def _ranked(pieces: DataFrame, *more: str) -> DataFrame:
    """Pieces with their rank within their length."""
    per_task = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.select(
        "length", "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return pieces.drop("ids").join(per_task, ["length", "part"]).withColumn(
        "rank", F.col("_before") + F.col("nth")
    )


def _place(ranked: DataFrame, plan: Plan) -> DataFrame:
    """Pieces in whole-piece windows with sequence and offset."""
    runs = sorted(plan.runs)
    table = np.array(runs, np.int64).reshape(-1, 5)
    keys, stream = (table[:, 0] << 48) + table[:, 1], dict(plan.stream_from)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = np.full(plan.capacity + 1, np.iinfo(np.int64).max)
        for length, rank in stream.items():
            limit[length] = rank
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            keep = rank < limit[length]
            batch = batch.filter(pa.array(keep))
            length, rank = length[keep], rank[keep]
            _, first, many, window, offset = table[
                np.searchsorted(keys, (length << 48) + rank, "right") - 1
            ].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(window + nth // many, pa.int64()),
                    pa.array(offset + nth % many * length, pa.int64()),
                ],
                names=COLUMNS,
            )

    return ranked.select(*COLUMNS[:5], "rank").mapInArrow(run, OUT)


def _cut_stream(pieces: DataFrame, ranked: DataFrame, plan: Plan) -> DataFrame:
    """The pieces of the stream, cut where its windows end."""
    lengths = sorted(plan.stream_from)
    facts = [(k, plan.stream_from[k], plan.stream_at[k]) for k in lengths]
    where = ranked.sparkSession.createDataFrame(facts, "length bigint, _from bigint, _at bigint")
    # A row for each length at most.
    streamed = ranked.join(F.broadcast(where), "length").filter("rank >= _from")
    streamed = streamed.select("part", "pos", F.expr("_at + (rank - _from) * length").alias("at"))
    held = pieces.filter(F.col("length").isin(lengths)) if len(lengths) < 100 else pieces
    held = held.select(*COLUMNS[:5], "part", "pos", "ids").join(streamed, ["part", "pos"])
    whole, ends = plan.edges()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        capacity, rest = plan.capacity, np.array([whole, *ends], np.int64)
        for batch in batches:
            rows = []
            for doc, start, length, _, total, raw, at in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                done = 0
                while done < length:
                    here = at + done
                    if here < whole:
                        window, begin = here // capacity, here // capacity * capacity
                        end = begin + capacity
                    else:
                        k = int(np.searchsorted(rest, here, "right")) - 1
                        window, begin, end = whole // capacity + k, int(rest[k]), int(rest[k + 1])
                    n = min(length - done, end - here)
                    crc = zlib.crc32(raw[4 * done : 4 * (done + n)])
                    rows.append((doc, start + done, n, crc, total, plan.stream_window + window, here - begin))
                    done += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 7,
                names=COLUMNS,
            )

    return held.select(*COLUMNS[:5], "ids", "at").mapInArrow(run, OUT)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, keep_ids: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Placed pieces (OUT), and the table of pieces with their ids (`keep_ids`: of all of them)."""
    pieces = settle(cut(docs, tokenizer, end_id, capacity, keep_ids), "pieces")
    stock = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_windows(stock, capacity)
    ranked = _ranked(pieces)
    placed = _place(ranked, plan)
    if plan.stream_tokens:
        placed = placed.unionByName(_cut_stream(pieces, ranked, plan))
    return placed, pieces
