import random

from pyspark.sql import Window, functions as F

from quayside.operators.numbering import global_row_id, surrogate_keys
from .conftest import bag


def test_equals_row_number(make):
    rng = random.Random(1)
    df = make([(rng.choice(["a", "b", None]), i, rng.random()) for i in range(2000)],
              "k string, n int, x double")
    expected = df.withColumn("ROW_ID", F.row_number().over(Window.orderBy("k", "n")).cast("bigint"))
    assert bag(global_row_id(df, ["k"], tie_break=["n"])) == bag(expected)


def test_hot_key_is_cut_into_ranges(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") < 20_000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("n"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = global_row_id(df, ["k"], tie_break=["n"])
        assert numbered.select("ROW_ID").distinct().count() == 30_000
        assert numbered.agg(F.min("ROW_ID"), F.max("ROW_ID")).first()[:] == (1, 30_000)
        ranged = df.repartitionByRange("k", "n").filter("k = 'hot'")
        assert ranged.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_copies_are_numbered_whatever_their_number(spark):
    df = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("n"), F.lit(None).cast("int").alias("z")
    )
    numbered = global_row_id(df, ["n"])
    assert sorted(r.ROW_ID for r in numbered.collect()) == list(range(1, 5_001))
    assert bag(numbered.drop("ROW_ID")) == bag(df)


def test_numbers_are_the_same_each_time(spark):
    df = spark.range(1_000).select((F.col("id") % 7).alias("k"), "id")
    first, second = (bag(global_row_id(df.repartition(n), ["k"])) for n in (3, 11))
    assert first == second


def test_empty(make):
    assert global_row_id(make([], "k string"), ["k"]).count() == 0


def test_surrogate_keys_continue(make):
    dim, new = make([(7, "a"), (3, "b")], "ID bigint, k string"), make([("d",), ("c",)], "k string")
    assert bag(surrogate_keys(new, dim, "ID", ["k"])) == [("c", 8), ("d", 9)]
    assert bag(surrogate_keys(new, dim.limit(0), "ID", ["k"])) == [("c", 1), ("d", 2)]
