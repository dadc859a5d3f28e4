import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quayside import settings
from quayside.sources import readers as r, writers as w
from .conftest import bag


def test_jdbc_credentials_stay_out_of_sight(monkeypatch):
    monkeypatch.setenv("WAREHOUSE_DB_USER", "reader")
    monkeypatch.setenv("WAREHOUSE_DB_PASSWORD", "hidden")
    source = r.JdbcSource("jdbc:x://host/db")
    assert source.options() == {"url": "jdbc:x://host/db", "user": "reader", "password": "hidden"}
    assert "hidden" not in repr(source) and "host" not in repr(source)
    monkeypatch.delenv("WAREHOUSE_DB_PASSWORD")
    assert "password" not in r.JdbcSource("u", "d.Driver").options()


def test_missing_path_is_empty_but_a_wrong_one_fails(spark, make):
    path = settings.new_path(spark, "absent")
    schema = make([], "n int").schema
    assert r.read_or_empty(spark, path, schema).count() == 0
    with pytest.raises(AnalysisException):
        r.read_files(spark, "parquet", path)


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_formats_keep_microseconds(spark, make, fmt):
    path = settings.new_path(spark, fmt)
    rows = spark.sql("SELECT 1 AS n, 'a,\"b' AS s, TIMESTAMP_NTZ '2024-01-01 10:00:00.123456' AS at, 0.1D AS x")
    w.write_files(rows, fmt, path)
    assert bag(r.read_files(spark, fmt, path, rows.schema)) == bag(rows)


def test_scan_is_pushed_down(spark):
    path = settings.new_path(spark, "scan")
    spark.range(100).select("id", (F.col("id") * 2).alias("b"), F.lit("x").alias("c")).write.parquet(path)
    plan = r.scan(spark.read.parquet(path), ["b"], F.col("id") > 90)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,90)" in plan and "ReadSchema: struct<id:bigint,b:bigint>" in plan


def test_incremental_slice_on_any_check_column(make, spark):
    df = spark.sql("""SELECT * FROM VALUES (1, DATE'2024-01-01', NULL), (2, NULL, DATE'2024-01-02'),
                      (3, DATE'2024-01-02', DATE'2024-01-01') AS t(n, a, b)""")
    assert bag(r.incremental_slice(df, ["a", "b"], "20240102").select("n")) == [(2,), (3,)]


def test_sql_text_is_bound(spark, make):
    found = r.read_sql(spark, "SELECT n FROM {t} WHERE s = :s", {"s": "it's"}, t=make([(1, "it's")], "n int, s string"))
    assert bag(found) == [(1,)]


def test_shared_folder_is_the_configured_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert settings.shared_dir(spark) == named.rstrip("/")
    assert settings.new_path(spark, "x") != settings.new_path(spark, "x")


def test_materialized_rows_read_back(make):
    df = make([(1, "a"), (2, None)], "n int, s string")
    assert bag(settings.materialize(df, "m")) == bag(df)
