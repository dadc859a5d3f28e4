"""JDBC, files, SQL text and incremental slices as DataFrames."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..settings import materialize

# Text formats that keep every digit; Spark's own drop microseconds on the way out and back.
LOSSLESS_TEXT = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


@dataclass(frozen=True)
class JdbcSource:
    """Where a database is.  Credentials come from the two named environment variables and are
    kept out of the representation, so neither logs nor errors show them."""

    url: str
    driver: str | None = None
    user_env: str = "WAREHOUSE_DB_USER"
    password_env: str = "WAREHOUSE_DB_PASSWORD"

    def options(self) -> dict[str, str]:
        named = {"user": os.environ.get(self.user_env), "password": os.environ.get(self.password_env),
                 "driver": self.driver}
        return {"url": self.url, **{k: v for k, v in named.items() if v}}

    def __repr__(self) -> str:
        return "JdbcSource(...)"


@dataclass(frozen=True)
class JdbcRange:
    """Read in parallel: one query per range of a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int


def read_jdbc(
    spark: SparkSession,
    source: JdbcSource,
    query: str,
    split: JdbcRange | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Rows of a query.  Filters and column choice made on the result are pushed to the database."""
    reader = spark.read.format("jdbc").options(**source.options()).option("fetchsize", fetch_size)
    if split is None:
        return reader.option("query", query).load()
    return reader.options(
        # a partitioned read takes a table expression, not a query
        dbtable=f"({query}) src",
        partitionColumn=split.column,
        lowerBound=split.lower,
        upperBound=split.upper,
        numPartitions=split.partitions,
    ).load()


def scan(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """Columns and predicate of a scan; both end up in the reader (``ReadSchema``, ``PushedFilters``)."""
    kept = df if where is None else df.filter(where)
    return kept.select(*columns)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files under ``path``, or no rows if there is nothing there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_files(
    spark: SparkSession, fmt: str, path: str, schema: T.StructType | None = None, **options
) -> DataFrame:
    """Files of any format Spark has a reader for (csv, json, orc, parquet, text, avro ...)."""
    text = LOSSLESS_TEXT if fmt in ("csv", "json") else {}
    reader = spark.read.format(fmt).options(**{**text, **options})
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_sql(
    spark: SparkSession, text: str, args: Mapping[str, object] | None = None, **frames: DataFrame
) -> DataFrame:
    """A query over named frames (``{frame}`` in the text), values bound as ``:name``."""
    return spark.sql(text, args=dict(args or {}), **frames)


def incremental_slice(df: DataFrame, check_columns: Sequence[str], day: str) -> DataFrame:
    """Rows that any of the check columns dates to ``day`` (``yyyyMMdd``).

    Written as a half-open range on the bare column, which a scan can use to skip files; a cast
    of the column to a date could not be pushed down.
    """
    start = F.to_date(F.lit(day), "yyyyMMdd")
    wanted = F.lit(False)
    for c in check_columns:
        wanted = wanted | ((F.col(c) >= start) & (F.col(c) < F.date_add(start, 1)))
    return df.filter(wanted)


FILE = "path string, size long, modified timestamp"


def new_files(spark: SparkSession, path: str, ledger: DataFrame, pattern: str = "*.parquet") -> DataFrame:
    """Files under ``path`` that the ledger does not have as they are now: (path, size, modified).

    Only the listing is looked at.  A file that was replaced under its old name is a new one.
    """
    listed = (
        spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=pattern).load(path)
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
    taken = ledger.select(*[F.col(c).alias(f"_{c}") for c in ("path", "size", "modified")])
    return listed.join(taken, [listed[c] == taken[f"_{c}"] for c in listed.columns], "left_anti")


def read_new_files(
    spark: SparkSession, path: str, ledger: DataFrame, schema: T.StructType, fmt: str = "parquet", **options
) -> tuple[DataFrame, DataFrame]:
    """Rows of the files not taken yet, and the ledger with those files added.

    Late files of an old day are read once, without looking at any row of the others.  The ledger is to be stored after
    the rows were: a load that fails in between takes its files again.  The names of the new files come to the driver, as
    a read has to name them.
    """
    found = materialize(new_files(spark, path, ledger, f"*.{fmt}"), "new-files")
    paths = [r["path"] for r in found.select("path").collect()]
    after = ledger.select(*found.columns).unionByName(found)
    if not paths:
        return spark.createDataFrame([], schema), after
    return spark.read.format(fmt).options(basePath=path, **options).schema(schema).load(paths), after
