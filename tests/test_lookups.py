"""Lookups and scans are broadcast by what they hold, not by the file that they lie in."""

from pyspark.sql import functions as F

from feedkit.operators.fragments import latest_attempt
from feedkit.plans.ordered import runs
from feedkit.plans.settle import settle
from feedkit.plans.skew import broadcast_limit, held_bytes, salted_lookup
from helpers import plan_of, tuples


def test_a_lookup_of_many_rows_in_a_small_file_is_not_broadcast(spark):
    rows = settle(spark.range(1000).select(F.col("id").alias("seq"), F.lit("path/").alias("path"), F.col("id").alias("n")), "rows")
    # 200,000 rows of equal texts: a file of a few hundred kilobytes, and some 40 MB in memory.
    lookup = settle(spark.range(200_000).select(F.lit("path/").alias("path"), F.col("id").alias("n"), F.repeat(F.lit("x"), F.lit(100)).alias("at")), "lookup")
    assert held_bytes(lookup) > broadcast_limit(spark)
    for how in ("inner", "left_semi", "left_anti"):
        joined = salted_lookup(rows, lookup, ["path", "n"], ["seq"], how)
        assert "BroadcastHashJoin" not in plan_of(joined)
        assert joined.count() == (0 if how == "left_anti" else 1000)


def test_a_scan_does_not_broadcast_its_rows(spark):
    rows = spark.range(300_000).select(
        F.lit("src/").alias("path"), F.expr("cast(id div 3 as string)").alias("filename"), F.lit("A").alias("identifier"), (F.col("id") % 3).alias("arrival")
    )
    told = runs(rows, ["path", "filename"], "arrival", "identifier")
    assert "BroadcastHashJoin" not in plan_of(told)
    assert told.filter("run_start = 0 AND last_run_start = 0").count() == 300_000


def test_latest_attempt_with_and_without_a_broadcast(spark):
    tries = F.explode(F.array(F.lit("A"), F.lit("B"))).alias("identifier")
    rows = spark.range(2000).select(
        F.lit("p/").alias("path"), F.expr("CASE WHEN id < 1500 THEN 'hot' ELSE cast(id as string) END").alias("filename"),
        (F.col("id") + 1).alias("idx"), F.lit(5000).cast("bigint").alias("cnt"), F.col("id").alias("_at"), tries,
    )
    rows = rows.withColumn("arrival", F.col("_at") + F.when(F.col("identifier") == "B", 5000).otherwise(0)).drop("_at")
    few = tuples(latest_attempt(rows), "filename", "identifier", "idx")
    assert len(few) == 2000 and {r[1] for r in few} == {"B"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert tuples(latest_attempt(rows), "filename", "identifier", "idx") == few
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_limit_is_read_as_spark_spells_it(spark):
    try:
        for text, number in (("-1", -1), ("1", 1), ("10MB", 10 << 20), ("10485760b", 10 << 20), ("64k", 64 << 10), ("1g", 1 << 30)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert broadcast_limit(spark) == number
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
