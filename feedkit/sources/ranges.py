"""Files of any size, read as byte ranges on the executors.

A data source lists the paths once, on the driver, as Spark's own file sources do, and cuts the files
into ranges; tasks take a bounded number of bytes each, and of a large file every task reads its own
part. No cell is larger than a range. Empty files and empty directories are listed, too.

Paths may be local ones that all executors share, or URIs of any store that pyarrow's file systems
know. A file that is shorter than it was when it was listed ends the job: what was promised is not there.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from feedkit.functions.paths import dirname
from feedkit.operators.fragments import RANGE_BYTES, stable_uuid

# Executors get the classes with the query, whether or not the package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What one task reads, in bytes and in ranges.
TASK_BYTES, TASK_RANGES = 128 << 20, 1000
RANGES = (
    "arg_pos int, filepath string, kind string, modified_at timestamp, size bigint, "
    "idx bigint, cnt bigint, offset bigint, part binary"
)
_ARROW = pa.schema(
    [
        ("arg_pos", pa.int32()),
        ("filepath", pa.string()),
        ("kind", pa.string()),
        ("modified_at", pa.timestamp("us", "UTC")),
        ("size", pa.int64()),
        ("idx", pa.int64()),
        ("cnt", pa.int64()),
        ("offset", pa.int64()),
        ("part", pa.binary()),
    ]
)


@dataclass
class Range:
    arg_pos: int
    filepath: str
    kind: str
    modified_at: dt.datetime | None
    size: int
    idx: int
    cnt: int
    offset: int
    length: int


@dataclass
class Ranges(InputPartition):
    ranges: list[Range]

    def __init__(self, ranges: list[Range]) -> None:
        super().__init__(0)
        self.ranges = ranges


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def listed(arg_pos: int, path: str, range_bytes: int) -> Iterator[Range]:
    """All ranges below a path: of files, of empty files, and of directories that hold nothing."""
    store, root = opened(path)
    own = store.get_file_info(root)
    if own.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [own] if own.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root, recursive=True))
    parents = {f.path.rstrip("/").rpartition("/")[0] for f in found}
    for info in found:
        name = info.path.rstrip("/")
        if info.type == fs.FileType.Directory:
            if name not in parents:
                yield Range(arg_pos, name, "dir", info.mtime, 0, 1, 1, 0, 0)
            continue
        count = max(1, -(-info.size // range_bytes))
        for i in range(count):
            begin = i * range_bytes
            yield Range(arg_pos, name, "file", info.mtime, info.size, i + 1, count, begin, min(range_bytes, info.size - begin))


class RangeReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths = json.loads(options["paths"])
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.with_content = options.get("content", "true").lower() == "true"
        if self.range_bytes < 1:
            raise ValueError("range_bytes must be at least 1")

    def partitions(self) -> Sequence[Ranges]:
        out, own, size = [], [], 0
        for pos, path in enumerate(self.paths):
            for one in listed(pos, path, self.range_bytes):
                if own and (size + one.length > TASK_BYTES or len(own) >= TASK_RANGES):
                    out.append(Ranges(own))
                    own, size = [], 0
                own.append(one)
                size += one.length if self.with_content else 0
        return [*out, Ranges(own)] if own else out

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for one in partition.ranges:
            rows.append((one, self._bytes(one)))
            size += one.length
            if size >= self.range_bytes or len(rows) >= TASK_RANGES:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _bytes(self, one: Range) -> bytes | None:
        if not self.with_content or one.kind == "dir":
            return None
        if not one.length:
            return b""
        path = self.paths[one.arg_pos]
        store, _ = opened(path)
        with store.open_input_file(one.filepath) as file:
            data = file.read_at(one.length, one.offset)
        if len(data) != one.length:
            raise OSError(f"{one.filepath} is shorter than when it was listed")
        return data

    @staticmethod
    def _batch(rows: list[tuple[Range, bytes | None]]) -> pa.RecordBatch:
        columns = [pa.array([getattr(r, f.name) for r, _ in rows], f.type) for f in list(_ARROW)[:-1]]
        return pa.RecordBatch.from_arrays([*columns, pa.array([b for _, b in rows], pa.binary())], schema=_ARROW)


class ByteRanges(DataSource):
    """`spark.read.format("byte_ranges")` with options paths (a JSON list), range_bytes and content."""

    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return RANGES

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)


def scan_ranges(
    spark: SparkSession, paths: Sequence[str], range_bytes: int = RANGE_BYTES, content: bool = True
) -> DataFrame:
    """One row per byte range of the files below the paths, and per empty file or directory: RANGES, path
    and filename.

    Files up to `range_bytes` are one row (idx = cnt = 1). Without `content` nothing is read and `part`
    is null.
    """
    spark.dataSource.register(ByteRanges)
    reader = spark.read.format("byte_ranges").option("paths", json.dumps(list(paths)))
    rows = reader.option("range_bytes", str(range_bytes)).option("content", str(content).lower()).load()
    return rows.withColumns(
        {"path": dirname(F.col("filepath")), "filename": F.regexp_extract("filepath", r"([^/]*)$", 1)}
    )


def scan_fragments(spark: SparkSession, paths: Sequence[str], max_size: int = RANGE_BYTES) -> DataFrame:
    """The ranges in the form of fragments, as `reassemble` reads them: files above `max_size` in pieces
    named by their path, size and time, the others whole (cnt is 1)."""
    rows = scan_ranges(spark, paths, max_size)
    return rows.withColumns(
        {
            "identifier": stable_uuid(F.col("filepath"), F.col("size"), F.unix_micros("modified_at")),
            "orig_size": F.col("size"),
            "orig_filename": F.col("filename"),
            "arrival": F.col("idx"),
        }
    )
