"""From raw documents to packed training sequences, in five stages.

Every stage works on all that the one before kept, and is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedkit.llm import mixing, neardup, packing, pii, quality
from feedkit.llm.queries import small_batches, tokenizer_file
from feedkit.plans.settle import settle

#: A row's number, in a column that documents do not have.
ROW = "pipeline_row_number"
#: Bits of a row's number that tell its place in a file.
FILE_BITS = 40


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all rows with labels, does not reject."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels, F.lit(True)))


def numbered_rows(docs: DataFrame) -> DataFrame:
    """`docs` with ROW, a number that is the same whenever the rows are read.

    Rows that are read from files are named by their place there, in the order of the paths. Others have no
    place, or share one, and are written with their numbers.
    """
    try:
        place = docs.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at"))
    except AnalysisException:
        return settle(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    paths = place.select("_path").distinct()  # a row for each file
    paths = paths.select("_path", (F.row_number().over(Window.orderBy("_path")) - 1).cast("bigint").alias("_file"))
    number = F.shiftleft("_file", FILE_BITS) + F.col("_at")
    placed = place.join(settle(paths, "paths"), "_path").select(*docs.columns, number.alias(ROW))
    if placed.groupBy(ROW).count().filter("count > 1").isEmpty():
        return placed
    return settle(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the first, of each group of near duplicates.

    Rows are numbered and told apart by their numbers, so rows that share an id, or have none, are judged
    each by its own text.
    """
    small_batches(spark)
    numbered = numbered_rows(docs)
    texts = numbered.select(F.col(ROW).alias("doc_id"), "text")
    found = neardup.near_duplicates(texts, width=5, percent=80)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias(ROW))
    return numbered.join(gone, ROW, "left_anti").select(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind."""
    small_batches(spark)
    masked = pii.mask(docs, pii.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of its curriculum."""
    return mixing.drawn(docs, mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 2048."""
    small_batches(spark)
    placed, _ = packing.pack(docs, tokenizer_file(), end_id=1)
    return placed


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("personal_data", private),
    ("mixing", mixed),
    ("packing", packed),
]

#: Trained models, hashes and tokenizers are not SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settle(docs, name)
    return docs
