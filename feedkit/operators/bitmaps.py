"""Which pieces of a file have arrived, as bitmaps that can be kept and merged.

A file's indices lie in chunks of 32,768; a row has a chunk's bits (4 KiB) and what the file's first row says
about it. Bitmaps of a day are stored, and merged with those of the next day's feed by `or`, so the status
of all days needs the fragments of the last one only. Partial aggregation builds them inside the map
tasks: what moves is a row for each chunk of a file, however many pieces and copies it has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedkit.operators.fragments import _usable, first_row

#: Bits of a chunk: what Spark's bitmap functions put into one.
CHUNK = 32_768


def piece_bitmaps(
    fragments: DataFrame, by: Sequence[str] = ("identifier",), order: str = "arrival"
) -> DataFrame:
    """by..., chunk (from 1), bits and first: one row for each chunk of a file that has a piece."""
    rows = fragments.filter(_usable()).select(*by, "idx", first_row(order, ["cnt"]).alias("_f"))
    return rows.groupBy(*by, F.bitmap_bucket_number("idx").alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("idx")).alias("bits"), F.min("_f").alias("first")
    )


def merge_bitmaps(*tables: DataFrame, by: Sequence[str] = ("identifier",)) -> DataFrame:
    """Bitmaps of several feeds as those of one: pieces of all, and the first row of all."""
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(*by, "chunk").agg(F.bitmap_or_agg("bits").alias("bits"), F.min("first").alias("first"))


def _with_count(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with `cnt`, the number of pieces that the file's first row names.

    A window holds a file's chunks: 8,192 rows for 2^28 pieces.
    """
    return bitmaps.withColumn("cnt", F.min("first").over(Window.partitionBy(*by))["cnt"])


def bitmap_status(bitmaps: DataFrame, by: Sequence[str] = ("identifier",)) -> DataFrame:
    """by..., seen, cnt, state, as `fragment_status` tells them from the fragments."""
    rows = _with_count(bitmaps, by)
    last = F.col("cnt") - (F.col("chunk") - 1) * CHUNK  # how many of the chunk's bits count
    whole = F.expr("substring(bits, 1, cast(_last div 8 as int))")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(_last div 8 as int) + 1, 1)")), 16, 10).cast("int")
    mask = F.expr("shiftleft(1, cast(_last % 8 as int)) - 1")
    seen = (
        F.when(F.col("_last") >= CHUNK, F.bitmap_count("bits"))
        .when(F.col("_last") <= 0, F.lit(0))
        .otherwise(F.bitmap_count(whole) + F.bit_count(byte.bitwiseAND(mask)))
    )
    counted = rows.withColumn("_last", last).select(*by, "cnt", seen.cast("bigint").alias("_seen"))
    status = counted.groupBy(*by).agg(F.sum("_seen").alias("seen"), F.first("cnt").alias("cnt"))
    state = F.when(F.col("seen") == F.col("cnt"), "complete").otherwise("incomplete")
    return status.select(*by, "seen", "cnt", state.alias("state"))


def bitmap_gaps(bitmaps: DataFrame, by: Sequence[str] = ("identifier",)) -> DataFrame:
    """by..., from_n, to_n: the ranges of indices in 1..cnt that have not arrived."""
    rows = _with_count(bitmaps, by)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in by), "from_n bigint", "to_n bigint"])
    width = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, begins, ends = [], [], []
            columns = (batch.column(width + i).to_pylist() for i in range(3))
            for i, (chunk, bits, cnt) in enumerate(zip(*columns, strict=True)):
                low = (chunk - 1) * CHUNK
                most = max(0, min(CHUNK, cnt - low))
                there = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[:most]
                edges = np.flatnonzero(np.diff(np.concatenate([[1], there, [1]])))
                begins.append(low + 1 + edges[::2])
                ends.append(low + edges[1::2])
                at.append(np.full(len(edges) // 2, i))
            flat = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (at, begins, ends)]
            named = [batch.column(k).take(pa.array(flat[0])) for k in range(width)]
            yield pa.RecordBatch.from_arrays(
                [*named, pa.array(flat[1], pa.int64()), pa.array(flat[2], pa.int64())],
                names=[*by, "from_n", "to_n"],
            )

    inside = rows.select(*by, "chunk", "bits", "cnt").mapInArrow(run, schema)
    # Chunks without a piece lie between those that have one, or behind the last.
    along = Window.partitionBy(*by).orderBy("chunk")
    last_chunk = F.expr(f"(cnt - 1) div {CHUNK} + 1")
    told = rows.filter(F.col("chunk") <= last_chunk).select(*by, "chunk", "cnt")
    told = told.withColumns({"_before": F.coalesce(F.lag("chunk").over(along), F.lit(0)), "_next": F.lead("chunk").over(along)})
    before = told.filter(F.col("chunk") - F.col("_before") > 1).select(
        *by, (F.col("_before") * CHUNK + 1).alias("from_n"), ((F.col("chunk") - 1) * CHUNK).alias("to_n")
    )
    behind = told.filter(F.col("_next").isNull() & (F.col("chunk") < last_chunk)).select(
        *by, (F.col("chunk") * CHUNK + 1).alias("from_n"), F.col("cnt").alias("to_n")
    )
    ranges = inside.unionByName(before).unionByName(behind)
    # Ranges that touch a chunk's edge may go on in the next; a file has two of a chunk at most.
    touches = ((F.col("from_n") - 1) % CHUNK == 0) | (F.col("to_n") % CHUNK == 0)
    edges = ranges.filter(touches)
    order = Window.partitionBy(*by).orderBy("from_n")
    opens = F.coalesce(F.lag("to_n").over(order) + 1 != F.col("from_n"), F.lit(True))
    edges = edges.withColumn("_opens", F.when(opens, F.col("from_n")))
    edges = edges.withColumn("_run", F.max("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = edges.groupBy(*by, "_run").agg(F.max("to_n").alias("to_n")).withColumnRenamed("_run", "from_n")
    return ranges.filter(~touches).unionByName(joined.select(*by, "from_n", "to_n"))
