"""Rows are told apart by their place in their files, without a copy of their texts."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_pipeline import ROW, numbered_rows

SF = "/root/testdata/sf0.001"


def copied(df):
    return any("/numbered-" in f for f in df.inputFiles())


def test_rows_of_files_are_not_copied(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.union(docs.limit(50)).repartition(5).write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    numbered = numbered_rows(docs)
    assert numbered.columns == [*docs.columns, ROW] and not copied(numbered)
    assert numbered.select(ROW).distinct().count() == docs.count()
    # The same numbers whatever else is read.
    again = numbered.select(ROW, "doc_id").join(numbered.select(ROW, F.col("doc_id").alias("other"), "text"), ROW)
    assert again.filter("doc_id <> other").isEmpty() and again.count() == docs.count()
    kept = corpus_pipeline.without_near_duplicates(spark, docs, SF)
    assert not copied(kept) and kept.columns == docs.columns
    assert kept.count() == kept.select("text").distinct().count() < docs.count()


@pytest.mark.parametrize("how", ["union", "explode", "made"])
def test_rows_without_a_place_of_their_own_are_copied(spark, how):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if how == "union":
        docs = docs.union(docs)
    elif how == "explode":
        docs = docs.withColumn("nth", F.explode(F.array(F.lit(1), F.lit(2))))
    else:
        docs = spark.createDataFrame([(1, "a"), (1, "a")], "doc_id bigint, text string")
    numbered = numbered_rows(docs)
    assert copied(numbered) and numbered.select(ROW).distinct().count() == docs.count()
