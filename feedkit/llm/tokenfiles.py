"""Token ids in Parquet files, in document order, readable by column and by page.

One row per document: `doc_id`, `file_start` (ids before it in its task's files), `n_tokens` and the
list `ids`. Numbers that only rise or stay small are delta-encoded, ids are dictionary-encoded (a
vocabulary fits the dictionary page). Row groups and pages have set sizes and column indexes are
written, so readers of the metadata never touch ids, and readers of a range of documents fetch its
pages alone.

Documents are dealt by ranges of doc_id, then of the rows' numbers as they are read, so the tasks, by the
number in their files' names, are in ascending order; a range is sorted inside its task, and rows that
share an id, or have none, spread over as many tasks as they fill. Null texts count as empty and still
get the end id; repeated rows each get a row; rows of equal doc_id follow as they are read. A null doc_id
comes first. Texts of any length are encoded whole. An empty table gives no rows. Extra columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedkit.llm.wordids import encoder, spans

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
SCHEMA = "doc_id bigint, file_start bigint, n_tokens bigint, ids array<int>"
#: The writer's settings: delta encoding for numbers, dictionaries for ids.
WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": "20000",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#file_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.dictionary.page.size": str(1 << 20),
}


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """SCHEMA rows in ascending doc_id order; `tokenizer` is a file for the tokenizers library."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, before = encoder(tokenizer, end_id), 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for part in spans(pc.binary_length(texts).to_pylist()):
                ids, sizes = words.encode(texts[part].to_pylist())
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(part.start, part.stop - part.start).cast(pa.int64()),
                        pa.array(before + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], ends]), pa.int32()),
                            pa.array(ids.view(np.int32), pa.int32()),
                        ),
                    ],
                    names=["doc_id", "file_start", "n_tokens", "ids"],
                )
                before += int(ends[-1])

    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    dealt = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole)
    # The ranges are sampled from two numbers, so texts are read once.
    order = ["doc_id", "_row"]
    dealt = dealt.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(encode, SCHEMA)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Write the documents' ids below `folder`."""
    encode_documents(docs, tokenizer, end_id).write.options(**WRITER).parquet(folder)


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    # A task's number stands in the names of its files, however many they are.
    task = F.regexp_extract(F.col("_metadata.file_name"), "^part-([0-9]+)", 1).cast("bigint")
    return spark.read.schema(SCHEMA).parquet(folder).withColumn("_task", task)


def _with_start(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Replace `file_start` by `start`, the ids of all documents before; reads metadata alone."""
    # Tasks are dealt by range, so their numbers are in document order; a row for each task.
    tasks = _rows(spark, folder).groupBy("_task")
    tasks = tasks.agg(F.max(F.col("file_start") + F.col("n_tokens")).alias("_ids"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("_task", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    rest = [c for c in rows.columns if c not in ("doc_id", "file_start", "_task")]
    start = (F.col("_before") + F.col("file_start")).alias("start")
    return rows.join(tasks, "_task").select("doc_id", start, *rest)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids."""
    return _with_start(_rows(spark, folder), spark, folder)


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, the checksum of the ids read as 32-bit numbers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crcs, pa.int64()), batch.column(4)],
                names=["doc_id", "file_start", "n_tokens", "ids_crc32", "_task"],
            )

    # Ids turn into checksums before anything moves.
    rows = _rows(spark, folder).mapInArrow(
        sums, "doc_id bigint, file_start bigint, n_tokens bigint, ids_crc32 bigint, _task bigint"
    )
    return _with_start(rows, spark, folder)
