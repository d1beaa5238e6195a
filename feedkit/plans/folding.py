"""Ordered folds over the pieces of a file, in constant memory.

Pieces are dealt by file and sorted by position; a task reads them in Arrow batches and holds one running
digest and one batch, however large the file is. A file is one sequence, for a digest has to read it from
the front; different files run side by side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digest names, as hashlib has them.
ALGORITHMS = {"SHA224": "sha224", "SHA256": "sha256", "SHA384": "sha384", "SHA512": "sha512", "SHA1": "sha1", "MD5": "md5"}


def file_key(by: Sequence[str]) -> Column:
    """One text for the columns that name a file; nulls are told from texts."""
    return F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)]))


def arrived_first(order: str) -> Column:
    """An order in which rows without an arrival come last."""
    return F.struct(F.col(order).isNull().alias("late"), F.col(order).alias("at"))


class Fold:
    """The state of the file that is being read: which position comes next, its digest, its bytes."""

    def __init__(self, algo: str | None) -> None:
        name = ALGORITHMS.get((algo or "").upper().replace("-", ""))
        self.hash = hashlib.new(name, usedforsecurity=False) if name else None
        self.last: int | None = None
        self.seen = self.bytes = 0

    def take(self, position: int, part) -> bool:
        """Read a piece; false for a further copy of one that was read."""
        if position == self.last:
            return False
        self.last, self.seen = position, self.seen + 1
        if part is not None:
            self.bytes += part.size
            if self.hash is not None:
                self.hash.update(part)
        return True

    def digest(self) -> str | None:
        return self.hash.hexdigest() if self.hash is not None else None


def in_order(pieces: DataFrame, by: Sequence[str], position: str, first: Column) -> DataFrame:
    """Pieces dealt by file, in order of position within it, the first copy ahead of the others."""
    keyed = pieces.withColumns({"_key": file_key(by), "_first": first}).repartition("_key")
    return keyed.sortWithinPartitions("_key", position, "_first").drop("_first")


def fold_files(
    pieces: DataFrame, by: Sequence[str], position: str, payload: str, algo: str, first: Column
) -> DataFrame:
    """by..., position, payload, n_pieces, n_bytes, digest: the pieces and a last row for each file.

    A piece's row has its position and payload; further copies are left out. The file's last row has a null
    position, and how many pieces and bytes were read and their digest by the file's `algo` (null if that
    is not supported).
    """
    told = pieces.select(*by, position, payload, F.col(algo).cast("string").alias("_algo"), first.alias("_first_copy"))
    told = in_order(told, by, position, F.col("_first_copy")).drop("_first_copy")
    names = [*by, position, payload, "n_pieces", "n_bytes", "digest"]
    kinds = {f.name: f.dataType.simpleString() for f in told.schema}
    schema = ", ".join(
        [*(f"`{c}` {kinds[c]}" for c in (*by, position, payload)), "n_pieces bigint", "n_bytes bigint", "digest string"]
    )
    width = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fold, head = None, None, None

        def last_row() -> pa.RecordBatch:
            nulls = [pa.nulls(1, c.type) for c in (head.column(width), head.column(width + 1))]
            facts = [pa.array([fold.seen], pa.int64()), pa.array([fold.bytes], pa.int64()), pa.array([fold.digest()], pa.string())]
            return pa.RecordBatch.from_arrays([*head.columns[:width], *nulls, *facts], names=names)

        for batch in batches:
            keys = batch.column("_key").to_pylist()
            positions, algos = batch.column(width).to_pylist(), batch.column("_algo").to_pylist()
            parts, kept = batch.column(width + 1), []

            def flush(batch=batch, kept=kept) -> Iterator[pa.RecordBatch]:
                if kept:
                    rows = batch.take(pa.array(kept))
                    empty = [pa.nulls(len(kept), t) for t in (pa.int64(), pa.int64(), pa.string())]
                    yield pa.RecordBatch.from_arrays([*rows.columns[: width + 2], *empty], names=names)
                    kept.clear()

            for i, own in enumerate(keys):
                if own != key or fold is None:
                    yield from flush()
                    if fold is not None:
                        yield last_row()
                    # A copy, so that the batch of the file's first row does not stay in memory.
                    head = batch.take(pa.array([i])).select(list(range(width + 2)))
                    head = head.set_column(width + 1, head.schema.field(width + 1), pa.nulls(1, head.column(width + 1).type))
                    key, fold = own, Fold(algos[i])
                if fold.take(positions[i], parts[i].as_buffer()):
                    kept.append(i)
            yield from flush()
        if fold is not None:
            yield last_row()

    return told.select(*by, position, payload, "_algo", "_key").mapInArrow(run, schema)


def file_digests(
    pieces: DataFrame, by: Sequence[str], position: str, payload: str, algo: str, first: Column
) -> DataFrame:
    """by..., n_pieces, n_bytes, digest: one row for each file."""
    # Pieces end in the task that read them.
    folded = fold_files(pieces, by, position, payload, algo, first)
    return folded.filter(F.col(position).isNull()).select(*by, "n_pieces", "n_bytes", "digest")
