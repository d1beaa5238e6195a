"""Files written to a folder that all executors share, piece by piece.

A file's ordered pieces stream into a hidden name; the last row's verdict renames it or takes it away. So
a file is there whole or not at all, a task that is tried again writes the same file again, and a task
holds one piece, however large the file is. Names that leave the folder are refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedkit.functions.paths import clean, escapes
from feedkit.operators.fragments import ordered_pieces

ACCEPTED = ("complete", "unverified", "stored")
STORED = "filepath string, state string, size bigint, digest string"


def _store_of(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder.removeprefix("file:")


class _Writer:
    """One file at a time: `write` its pieces, then `close` with its verdict."""

    def __init__(self, folder: str) -> None:
        self.store, self.root = _store_of(folder)
        self.name: str | None = None
        self.out = None

    def begin(self, name: str) -> None:
        folder, _, base = f"{self.root.rstrip('/')}/{name}".rpartition("/")
        self.name, self.hidden = f"{folder}/{base}", f"{folder}/.{base}.{uuid.uuid4().hex}"
        self.store.create_dir(folder, recursive=True)
        self.out = self.store.open_output_stream(self.hidden)

    def write(self, part) -> None:
        if part is not None:
            self.out.write(part)

    def close(self, keep: bool) -> None:
        self.out.close()
        if keep:
            self.store.move(self.hidden, self.name)
        else:
            self.store.delete_file(self.hidden)
        self.out = None


def inside(path: Column) -> Column:
    """The cleaned path below the folder; null where it leaves it or names no file."""
    name = clean(path)
    return F.when(~escapes(name) & ~name.isin("", ".", "/"), F.ltrim(name, F.lit("/")))


def store_pieces(rows: DataFrame, folder: str, name: str = "name") -> DataFrame:
    """Write files from the rows of `ordered_pieces`, with the path of each file in `name`: STORED.

    One row for each file: `complete` and `unverified` ones are there afterwards, `corrupt` and `incomplete`
    ones are not, nor is `refused`, a path that leaves the folder. Files of one path replace each other.
    Writing happens when the result is read.
    """
    told = rows.select(inside(F.col(name)).alias("_name"), F.col(name).alias("_given"), "part", "state", "size", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(folder)
        for batch in batches:
            names, given = batch.column("_name").to_pylist(), batch.column("_given").to_pylist()
            states, parts = batch.column("state").to_pylist(), batch.column("part")
            done = []
            for i, state in enumerate(states):
                if names[i] is not None and writer.out is None:
                    writer.begin(names[i])
                if state is None:
                    if names[i] is not None:
                        writer.write(parts[i].as_buffer())
                    continue
                if names[i] is not None:
                    writer.close(state in ACCEPTED)
                done.append((i, given[i] if names[i] is None else writer.name, state if names[i] is not None else "refused"))
            at = pa.array([i for i, _, _ in done], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n for _, n, _ in done], pa.string()),
                    pa.array([s for _, _, s in done], pa.string()),
                    batch.column("size").take(at),
                    batch.column("digest").take(at),
                ],
                names=["filepath", "state", "size", "digest"],
            )

    return told.mapInArrow(run, STORED)


def store_fragments(fragments: DataFrame, folder: str, order: str = "arrival") -> DataFrame:
    """Put fragments of files of any size together on disk, at path and filename: STORED."""
    rows = ordered_pieces(fragments, ["path", "filename", "identifier"], order)
    return store_pieces(rows.withColumn("name", F.concat_ws("/", "path", "filename")), folder)


def store_files(files: DataFrame, folder: str) -> DataFrame:
    """Write rows of whole files (path, filename, content) below the folder, each in one piece: STORED."""
    whole = files.select(
        F.concat_ws("/", "path", "filename").alias("name"),
        F.coalesce("content", F.lit(b"")).alias("part"),
        F.lit("stored").alias("state"),
    )
    piece = F.struct("part", F.lit(None).cast("string").alias("state"), F.lit(None).cast("bigint").alias("size"))
    last = F.struct(F.lit(None).cast("binary").alias("part"), "state", F.octet_length("part").cast("bigint").alias("size"))
    rows = whole.select("name", F.inline(F.array(piece, last))).withColumn("digest", F.lit(None).cast("string"))
    return store_pieces(rows, folder)
