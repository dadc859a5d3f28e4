import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from quayside.operators.compare import copy_counts, diff_rows, except_distinct, is_changed
from quayside.operators.slices import changed_slices, slice_filter
from quayside.settings import new_path
from quayside.sources import writers as w
from .conftest import bag

D1, D2, D3 = date(2023, 10, 1), date(2023, 10, 2), date(2023, 10, 3)
SCHEMA = "n int, day date"


@pytest.fixture
def path(spark):
    return new_path(spark, "test")


def files(path, day):
    return {f for f in os.listdir(f"{path.removeprefix('file:')}/day={day}") if f.endswith(".parquet")}


def test_difference_modes(make):
    stored, source = make([(1,), (1,), (2,)], "n int"), make([(1,), (2,), (3,)], "n int")
    assert not is_changed(stored, source, "removed")
    assert is_changed(stored, source, "symmetric")
    assert bag(diff_rows(stored, source, "copies").select("n")) == [(1,), (3,)]
    assert bag(copy_counts(stored, source)) == [(1, 2, 1), (2, 1, 1), (3, 0, 1)]


def test_except_equals_subtract(make):
    a = make([(1, None), (1, None), (2, "x"), (3, "y")], "n int, s string")
    b = make([(2, "x"), (3, None)], "n int, s string")
    assert bag(except_distinct(a, b)) == bag(a.subtract(b))


def test_slices_are_compared_without_shuffling_their_rows(make):
    schema = "a string, b string, x double, day date"
    stored = make([
        ("p", None, 0.0, D1), ("q", "r", 1.0, D1), ("p", None, 1.0, D2), ("s", "t", 2.0, D2), ("s", "t", 2.0, D2),
        ("u", "v", 3.0, D3), ("only", "stored", 0.0, date(2023, 10, 9)), (None, None, float("nan"), None)], schema)
    source = make([
        ("q", "r", 1.0, D1), ("p", None, -0.0, D1),  # the same in another order
        (None, "p", 1.0, D2), ("s", "t", 2.0, D2), ("s", "t", 2.0, D2),  # a value in another column
        ("u", "v", 3.0, D3), ("u", "v", 3.0, D3),  # one more copy
        ("new", "new", 0.0, date(2023, 10, 8)), (None, None, float("nan"), None)], schema)
    changed = changed_slices(stored, source, "day", "copies")
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(day#" in plan and "HashAggregate(keys=[day#" in plan
    assert bag(changed) == sorted([(D2,), (D3,), (date(2023, 10, 8),)], key=repr)
    assert bag(changed_slices(source, stored.filter("day IS NULL OR a = 'q'"), "day", "copies")) == [(D1,)]


@pytest.mark.parametrize("mode", ["copies", "symmetric"])
def test_nested_rows_are_compared_as_rows(make, mode):
    schema = "x array<double>, day date"
    stored, source = make([([0.0], D1), ([1.0], D2)], schema), make([([-0.0], D1), ([2.0], D2)], schema)
    assert bag(changed_slices(stored, source, "day", mode)) == [(D2,)]


def test_land_writes_changed_slices_only(spark, make, path):
    w.land_slices(make([(1, D1), (2, D2)], SCHEMA), path, "day")
    before = {day: files(path, day) for day in (D1, D2)}
    w.land_slices(make([(1, D1), (5, D2), (6, D3)], SCHEMA), path, "day")
    assert bag(spark.read.parquet(path).select("n", "day")) == [(1, D1), (5, D2), (6, D3)]
    assert files(path, D1) == before[D1] and files(path, D2) != before[D2]
    kept = files(path, D2)
    w.land_slices(make([(5, D2)], SCHEMA), path, "day")
    assert files(path, D2) == kept and spark.read.parquet(path).count() == 3


def test_land_removed_mode_ignores_additions(spark, make, path):
    w.land_slices(make([(1, D1)], SCHEMA), path, "day", "removed")
    w.land_slices(make([(1, D1), (2, D1)], SCHEMA), path, "day", "removed")
    assert spark.read.parquet(path).count() == 1
    w.land_slices(make([(2, D1)], SCHEMA), path, "day", "removed")
    assert bag(spark.read.parquet(path).select("n")) == [(2,)]


def test_land_given_days(spark, make, path):
    w.land_slices(make([(1, D1), (2, D2)], SCHEMA), path, "day", days=[D2])
    assert bag(spark.read.parquet(path).select("n")) == [(2,)]


def test_replace_slice_again_and_with_nothing(spark, make, path):
    schema = "n int, day int"
    w.append_slices(make([(1, 20231001), (2, 20231002)], schema), path, "day")
    for _ in range(2):
        w.replace_slice(make([(7,), (7,)], "n int"), path, "day", 20231001)
        assert bag(spark.read.parquet(path).select("n", "day")) == [(2, 20231002), (7, 20231001), (7, 20231001)]
    w.replace_slice(make([], "n int"), path, "day", 20231001)
    assert bag(spark.read.schema(schema).parquet(path)) == [(2, 20231002)]


def test_compact(spark, make, path):
    for i in range(3):
        w.append_slices(make([(i, D1)], SCHEMA), path, "day")
    w.append_slices(make([(9, D2)], SCHEMA), path, "day")
    untouched = files(path, D2)
    w.compact_partitions(spark, path, "day")
    assert len(files(path, D1)) == 1 and files(path, D2) == untouched
    stats = w.partition_stats(spark.read.parquet(path), "day")
    assert bag(stats) == [(D1, 3, 1), (D2, 1, 1)]
    assert w.top_partitions(spark.read.parquet(path), "day", 1).count() == 1


def test_tables(spark, make):
    base = new_path(spark, "db")
    name = "t_" + base[-8:]
    w.create_database(spark, name, base)
    table = f"{name}.t"
    schema = make([], "n int, s string, day date").schema
    w.create_table_if_absent(spark, table, schema, "day", {"keep": "5"})
    w.ensure_properties(spark, table, {"keep": "9", "age": "30"})
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert (props["keep"], props["age"]) == ("5", "30")
    rows = make([(1, "a", D1), (2, None, D1), (3, "a", D2), (4, "b", D3),
                 (5, "a", date(2023, 10, 4))], "n int, s string, day date")
    w.create_or_replace(rows, table, partition_by="day")
    w.delete_where(spark, table, F.col("s") == "a", "day")
    assert bag(spark.table(table).select("n")) == [(2,), (4,)]
    assert bag(spark.table(table).select("day").distinct()) == [(D1,), (D3,)]
    w.save_as_table(make([(1,)], "n int"), f"{name}.u")
    w.create_or_replace(make([("x",)], "s string"), f"{name}.u")
    assert bag(spark.table(f"{name}.u")) == [("x",)]
    w.repartition_table_by(spark, table, "s", f"{name}.by_s")
    assert bag(spark.table(f"{name}.by_s").select("n", "s")) == [(2, None), (4, "b")]


def test_slice_filter_prunes(spark, make, path):
    w.append_slices(make([(1, D1), (2, D2)], SCHEMA), path, "day")
    one = slice_filter(spark.read.parquet(path), "day", D1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and bag(one.select("n")) == [(1,)]


def test_hot_slice_is_written_by_many_tasks(spark, path):
    rows = spark.range(0, 40_000, 1, 8).selectExpr(
        "id AS n", "sha2(CAST(id AS STRING), 256) AS v",
        "CASE WHEN id % 3 = 0 THEN DATE'2023-10-01' ELSE date_add(DATE'2023-10-02', CAST(id % 5 AS INT)) END AS day",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        w.replace_slices(rows, path, "day")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(path, D1)) > 1
    assert spark.read.parquet(path).count() == 40_000


def test_null_slices_and_copies_land(spark, make, tmp_path):
    path, schema = str(tmp_path / "raw"), "v int, day string"
    w.land_slices(make([(1, "a"), (2, None)], schema), path, "day")
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 2]
    w.land_slices(make([(1, "a"), (1, "a"), (2, None), (3, None)], schema), path, "day")
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 1, 2, 3]


def test_rows_of_another_slice_are_an_error(make, tmp_path):
    with pytest.raises(Exception, match="another slice"):
        w.replace_slice(make([(1, "20230102")], "v int, day string"), str(tmp_path / "t"), "day", "20230101")


def test_delete_in_the_null_slice_and_in_quoted_ones(make, spark):
    rows = [(None, 1), (None, 2), ("it's", 1), ("it's", 2), ("a\\b", 1), ("plain", 3)]
    for name, n, left in (("part", 1, [r for r in rows if r[1] != 1]), ("all", 3, [("plain", 3)])):
        table = f"deleted_{name}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        w.create_or_replace(make(rows, "s string, n int"), table, partition_by="s")
        w.delete_where(spark, table, F.col("n") == 1 if n == 1 else F.col("n") < 3, "s")
        assert sorted(map(str, bag(spark.table(table).select("s", "n")))) == sorted(map(str, bag(make(left, "s string, n int"))))
        spark.sql(f"DROP TABLE {table}")
