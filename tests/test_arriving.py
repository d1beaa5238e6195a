"""Feeds that arrive: four micro-batches, whole batches, files of a bounded size."""

from pyspark.sql import functions as F

from feedkit.catalog import queries as q
from helpers import tuples

SF = "/root/testdata/sf0.001"


def test_a_larger_feed_arrives_in_more_files_of_whole_batches(spark, monkeypatch):
    files = q._files(spark, SF)
    held = files.agg(F.sum("size")).first()[0]
    whole = tuples(q.QUERIES["stage_stream"](spark, SF), "batch_id", "action", "files", "bytes")
    monkeypatch.setattr(q, "ARRIVING_BYTES", held // 20)
    folder, stream = q._arriving(spark, files, "arriving")
    here = spark.read.parquet(f"{folder}/in").withColumn("_file", F.input_file_name())
    assert here.count() == files.count()
    assert here.select("_file").distinct().count() > 10
    assert here.groupBy("batch_id").agg(F.countDistinct("_file").alias("n")).filter("n > 1").isEmpty()
    # A file has about as much as it should: twice that, where batches are few.
    assert here.groupBy("_file").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0] < 4 * held / 20
    numbers = []
    writer = stream.writeStream.foreachBatch(lambda rows, number: numbers.append((number, rows.count())))
    writer.option("checkpointLocation", f"{folder}/seen").trigger(availableNow=True).start().awaitTermination()
    assert len(numbers) in (3, 4) and sum(n for _, n in numbers) == files.count()
    assert tuples(q.QUERIES["stage_stream"](spark, SF), "batch_id", "action", "files", "bytes") == whole


def test_files_without_a_batch_arrive_in_many_files(spark, monkeypatch):
    files = q._files(spark, SF).withColumn("batch_id", F.expr("CASE WHEN seq % 3 > 0 THEN batch_id END"))
    held = files.agg(F.sum("size")).first()[0]
    monkeypatch.setattr(q, "ARRIVING_BYTES", held // 20)
    folder, _ = q._arriving(spark, files, "arriving")
    here = spark.read.parquet(f"{folder}/in").withColumn("_file", F.input_file_name())
    assert tuples(here, "seq", "batch_id", "size") == tuples(files, "seq", "batch_id", "size")
    assert here.filter("batch_id IS NULL").select("_file").distinct().count() > 10
    assert here.filter("batch_id IS NOT NULL").groupBy("batch_id").agg(F.countDistinct("_file").alias("n")).filter("n > 1").isEmpty()
    assert here.groupBy("_file").agg(F.sum("size").alias("n")).agg(F.max("n")).first()[0] < 4 * held / 20
