"""What the plans must and must not contain, and that hot keys are split."""

import os

import pytest
from pyspark.sql import functions as F

from portcheck.queries import QUERIES
from portcheck.views import Views
from quayside.operators import joins as j
from quayside.plans import yard
from quayside.settings import materialize

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", [
    "yard_throughput", "moves_view", "scd1_split", "scd2_split", "scd_full_outer", "fact_surrogate_lookup",
    "join_validity_left", "join_validity_two_roles", "slice_diff_symmetric", "run_log_latest",
])
def test_no_pairs_and_no_single_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython"):
        assert bad not in plan


@needs_tables
def test_moves_are_shuffled_once_for_items(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(yard.report_rows(Views(spark, SF_DIR).yard))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan parquet [l_orderkey") == 1
    assert plan.count("SortMergeJoin [ITEM_KEY") == 2  # cargo flags to items, items to moves


def skewed(spark, **conf):
    """Settings under which a few kilobytes already count as a hot partition."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        **conf,
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    return before


def restore(spark, before):
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    rows = df.collect()
    return rows, plan_of(df)


def hot(spark, rows=60_000):
    """A third and more of the rows under one key, made in many tasks."""
    return spark.range(0, rows, 1, 16).select(
        F.when(F.col("id") % 5 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("key"),
        F.col("id").alias("n"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


@pytest.mark.parametrize("unique", [False, True])
def test_hot_key_in_lookup_join_is_split_and_whole(spark, unique):
    facts = hot(spark)
    lookup = materialize(facts.select("key").distinct().withColumn("v", F.upper("key")), "lookup")
    before = skewed(spark)
    try:
        rows, plan = executed(j.enrich(facts, lookup, [("key", "key")], ["v"], "l", unique=unique))
    finally:
        restore(spark, before)
    assert "skew=true" in plan
    assert len(rows) == 60_000 and all(r.v_l == r.key.upper() for r in rows)


def test_hot_key_on_either_side_of_full_outer_is_split_and_whole(spark):
    few = materialize(hot(spark).select("key").distinct().filter("key <> 'hot'"), "few")
    before = skewed(spark)
    try:
        for left, right in ((hot(spark), few), (few, hot(spark))):
            rows, plan = executed(j.full_outer(left, right, [("key", "key")], "r"))
            assert "skew=true" in plan and len(rows) == 60_000
    finally:
        restore(spark, before)


@needs_tables
def test_hot_item_in_the_report_is_split_and_whole(spark):
    """One item holds more than a third of all moves."""
    tables = Views(spark, "/root/testdata/sf0.01" if os.path.isdir("/root/testdata/sf0.01") else SF_DIR).yard
    item = F.when(F.col("Z").isin("1", "2", "3", "4"), F.lit("7")).otherwise(F.col("ITEM_KEY"))
    moves = tables.moves.withColumn("ITEM_KEY", item).repartition(16)
    skew_tables = yard.YardTables(**{**tables.__dict__, "moves": moves})
    expected = sorted(map(repr, yard.report_rows(skew_tables).collect()))
    before = skewed(spark)
    try:
        rows, plan = executed(yard.report_rows(skew_tables))
    finally:
        restore(spark, before)
    assert "skew=true" in plan
    assert sorted(map(repr, rows)) == expected
