"""Vectors in blocks: matrices that travel as one row, and pairs of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a block's matrix.
BLOCK_BYTES = 1 << 19


def usable(vector: Column) -> Column:
    """Not null, and all components are finite numbers."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & finite


def matrix_of(column: pa.Array) -> np.ndarray:
    """A list column whose rows have one length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def rows_a_block(dim: int, width: int) -> int:
    return max(64, BLOCK_BYTES // max(1, dim * width))


def regrouped(batches: Iterator[pa.RecordBatch], keys: int, rows) -> Iterator[pa.Table]:
    """Tables of rows with equal values in the first `keys` columns, of at most `rows(table)` rows.

    The input is sorted by these columns; what is held is one block and one batch.
    """
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None or not held.num_rows else pa.concat_tables([held, table])
        while held.num_rows:
            same = np.ones(held.num_rows, bool)
            for k in range(keys):
                values = held.column(k).to_numpy()
                same &= values == values[0]
            run = held.num_rows if same.all() else int(np.argmin(same))
            most = rows(held)
            if run < held.num_rows or run >= most:
                cut = min(run, most)
                yield held.slice(0, cut)
                held = held.slice(cut)
            else:
                break
    if held is not None and held.num_rows:
        yield held


def paired(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """`pairs` (a, b) of block numbers with the blocks themselves as structs `left` and `right`.

    Each table of blocks has its number in `block`.
    """
    one = left.select(F.col("block").alias("a"), F.struct(*[c for c in left.columns if c != "block"]).alias("left"))
    two = right.select(F.col("block").alias("b"), F.struct(*[c for c in right.columns if c != "block"]).alias("right"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")
