"""JDBC, file and table sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..operators.slices import changed_digests, changed_slices, latest_digests, slice_digests
from ..settings import materialize, scratch
from .readers import LOSSLESS_TEXT, JdbcSource, read_or_empty


def write_jdbc(
    df: DataFrame, target: JdbcSource, table: str, mode: str = "append", connections: int = 10
) -> None:
    """``append``, or ``overwrite`` by truncating, which keeps the table's own definition.

    ``connections`` caps how many tasks write at once (the database's limit, not the data's);
    more partitions are merged, fewer are left as they are.
    """
    df.write.format("jdbc").options(**target.options()).options(
        dbtable=table, truncate="true", numPartitions=connections
    ).mode(mode).save()


def write_files(df: DataFrame, fmt: str, path: str, mode: str = "error", **options) -> None:
    text = LOSSLESS_TEXT if fmt in ("csv", "json") else {}
    df.write.format(fmt).options(**{**text, **options}).mode(mode).save(path)


def _by_slice(df: DataFrame, slice_col: str):
    """Few files per slice, and never one task for a slice that holds much of the data: AQE
    splits what is too large and merges what is too small under the REBALANCE hint."""
    return df.hint("rebalance", F.col(slice_col)).write.partitionBy(slice_col)


def append_slices(df: DataFrame, path: str, slice_col: str) -> None:
    _by_slice(df, slice_col).mode("append").parquet(path)


def replace_slices(df: DataFrame, path: str, slice_col: str) -> None:
    """Replace the slices ``df`` has rows for and leave all others."""
    _by_slice(df, slice_col).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


#: fixed values: what Spark writes as %XX in the names of partition folders, and its name for NULL and ''
_ESCAPED = {chr(c) for c in range(1, 0x20)} | set("\"#%'*/:=?\\{[]^\x7f")
_DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def slice_folder(spark: SparkSession, slice_col: str, value) -> str:
    """The name Spark's partition writer gives the folder of a slice."""
    escaped = lambda text: "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)
    text = None if value is None else spark.range(1).select(F.lit(value).cast("string")).first()[0]
    return f"{escaped(slice_col)}={escaped(text) if text else _DEFAULT_PARTITION}"


def replace_slice(df: DataFrame, path: str, slice_col: str, value) -> None:
    """Make ``df`` the one slice ``value`` (NULL is one); no rows empty it.  Running it again changes nothing.

    Rows are written as they are dealt, without a shuffle; a row of another slice is an error.
    """
    own = F.when(F.col(slice_col).eqNullSafe(F.lit(value)), F.lit(True)).otherwise(
        F.raise_error(F.lit(f"a row belongs to another slice than {value}")).cast("boolean"))
    rows = df.filter(own).drop(slice_col) if slice_col in df.columns else df
    rows.write.mode("overwrite").parquet(f"{path}/{slice_folder(df.sparkSession, slice_col, value)}")


def land_slices(
    source: DataFrame,
    path: str,
    slice_col: str,
    mode: str = "copies",
    days: Sequence | None = None,
) -> None:
    """Bring stored slices up to date with the source, rewriting only those that changed.

    One comparison covers one day or a whole back-fill; with nothing changed nothing is written.
    Only ``days`` (default: those the source has rows for) are read on either side.
    """
    with scratch(source.sparkSession):
        # read once: what is compared is what is stored, even if the source changes meanwhile
        source = materialize(_of_days(source, slice_col, days), "due-slices")
        due = source.select(F.col(slice_col).alias("_due")).distinct()
        stored = read_or_empty(source.sparkSession, path, source.schema)
        stored = stored.join(due, stored[slice_col].eqNullSafe(due["_due"]), "left_semi")
        # settled before writing starts: the write must not re-read the slices it is replacing
        changed = materialize(changed_slices(stored, source, slice_col, mode), "changed-slices")
        if not changed.isEmpty():
            replace_slices(_in_slices(source, changed, slice_col), path, slice_col)


def _of_days(source: DataFrame, slice_col: str, days: Sequence | None) -> DataFrame:
    if days is None:
        return source
    return source.filter(reduce(or_, [F.col(slice_col).eqNullSafe(F.lit(day)) for day in days], F.lit(False)))


def _in_slices(rows: DataFrame, slices: DataFrame, slice_col: str) -> DataFrame:
    named = slices.select(F.col(slice_col).alias("_named"))
    return rows.join(named, rows[slice_col].eqNullSafe(named["_named"]), "left_semi")


def _digest_log(spark: SparkSession, digest_path: str, rows: DataFrame, slice_col: str) -> DataFrame:
    kind = rows.schema[slice_col].dataType
    fields = [T.StructField(slice_col, kind), T.StructField("n_rows", T.LongType()),
              *[T.StructField(c, T.DecimalType(30, 0)) for c in ("sum_one", "sum_two")], T.StructField("version", T.LongType())]
    return read_or_empty(spark, digest_path, T.StructType(fields))


def _log_digests(log: DataFrame, digests: DataFrame, digest_path: str) -> None:
    version = (log.agg(F.max("version")).first()[0] or 0) + 1
    digests.withColumn("version", F.lit(version).cast("bigint")).coalesce(1).write.mode("append").parquet(digest_path)


def land_slices_by_digest(
    source: DataFrame, path: str, digest_path: str, slice_col: str, days: Sequence | None = None
) -> None:
    """As ``land_slices`` with ``copies``, but no stored row is read: the source's slices are compared with digests kept
    beside the table, three numbers a slice.

    Changed slices are written first and their digests logged after, so a load that fails in between writes
    those slices again.  A slice without a digest counts as changed; ``adopt_slices`` gives digests to a table that was
    written by other means, which must not be mixed with this one afterwards.
    """
    with scratch(source.sparkSession):
        source = materialize(_of_days(source, slice_col, days), "due-slices")
        log = _digest_log(source.sparkSession, digest_path, source, slice_col)
        changed = materialize(
            changed_digests(latest_digests(log, slice_col), slice_digests(source, slice_col), slice_col), "changed-slices")
        if not changed.isEmpty():
            replace_slices(_in_slices(source, changed, slice_col), path, slice_col)
            _log_digests(log, changed, digest_path)


def adopt_slices(stored: DataFrame, digest_path: str, slice_col: str) -> None:
    """Log digests of what is stored already: one pass over the table, once."""
    with scratch(stored.sparkSession):
        digests = materialize(slice_digests(stored, slice_col), "digests")
        if not digests.isEmpty():
            _log_digests(_digest_log(stored.sparkSession, digest_path, stored, slice_col), digests, digest_path)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Managed tables of the database live under ``location``."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")


def create_table_if_absent(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_by: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    pairs = ", ".join(f"'{k}'='{v}'" for k, v in (properties or {}).items())
    props = f" TBLPROPERTIES ({pairs})" if pairs else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{parts}{props}")


def ensure_properties(spark: SparkSession, table: str, defaults: Mapping[str, str]) -> None:
    """Set each property that the table does not have yet."""
    have = {row["key"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    missing = {k: v for k, v in defaults.items() if k not in have}
    if missing:
        pairs = ", ".join(f"'{k}'='{v}'" for k, v in missing.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def create_or_replace(
    df: DataFrame, table: str, fmt: str = "parquet", partition_by: str | None = None
) -> None:
    """The table with the rows and the schema of ``df``, whatever it was before."""
    writer = df.write.format(fmt).mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(table)


def save_as_table(df: DataFrame, table: str, mode: str = "append", fmt: str = "parquet") -> None:
    df.write.format(fmt).mode(mode).saveAsTable(table)


def repartition_table_by(spark: SparkSession, table: str, column: str, target: str) -> None:
    """A copy of the table laid out by ``column``."""
    _by_slice(spark.table(table), column).format("parquet").saveAsTable(target)


def table_location(spark: SparkSession, table: str) -> str:
    details = spark.sql(f"DESCRIBE EXTENDED {table}")
    return details.filter(F.col("col_name") == "Location").first()["data_type"]


def _literal(value) -> str:
    """A slice value as SQL text."""
    if value is None:
        return "NULL"
    quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"


def delete_where(spark: SparkSession, table: str, predicate: Column, slice_col: str) -> None:
    """Delete the rows the predicate is true for (not those it is unknown for).

    Slices that lose some rows are rewritten, slices that lose all are dropped, the rest is not
    touched; NULL is a slice.  What comes to the driver is the list of affected slices, as long as the list of
    partitions a drop has to name.
    """
    rows = spark.table(table)
    hit = F.coalesce(predicate, F.lit(False))
    affected = rows.groupBy(slice_col).agg(F.max(hit).alias("_some"), F.min(hit).alias("_all"))
    listed = affected.filter("_some").select(F.col(slice_col).alias("_slice"), "_all").collect()
    partial = [r["_slice"] for r in listed if not r["_all"]]
    emptied = [r["_slice"] for r in listed if r["_all"]]
    if partial:
        own = [F.col(slice_col).eqNullSafe(F.lit(day)) for day in partial]
        rest = rows.filter(reduce(or_, own) & ~hit)
        replace_slices(rest, table_location(spark, table), slice_col)
    if emptied:
        named = ", ".join(f"PARTITION (`{slice_col}` = {_literal(day)})" for day in emptied)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {named}")
    spark.catalog.refreshTable(table)


def file_stats(rows: DataFrame, slice_col: str) -> DataFrame:
    """Slice, path, rows and bytes of each file that holds rows of a file-based table."""
    return rows.groupBy(slice_col, F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("record_count"), F.max("_metadata.file_size").alias("bytes")
    )


def partition_stats(rows: DataFrame, slice_col: str) -> DataFrame:
    """Rows and files per slice of a file-based table."""
    return file_stats(rows, slice_col).groupBy(slice_col).agg(
        F.sum("record_count").alias("record_count"), F.count("*").alias("file_count")
    )


def partition_sizes(rows: DataFrame, slice_col: str) -> DataFrame:
    """Rows, files and bytes per slice of a file-based table."""
    return file_stats(rows, slice_col).groupBy(slice_col).agg(
        F.sum("record_count").alias("record_count"), F.count("*").alias("file_count"), F.sum("bytes").alias("bytes")
    )


def top_partitions(rows: DataFrame, slice_col: str, n: int) -> DataFrame:
    """The first ``n`` slices in order, with their statistics."""
    return partition_stats(rows, slice_col).orderBy(slice_col).limit(n)


def compact_partitions(spark: SparkSession, path: str, slice_col: str, max_files: int = 1) -> None:
    """Rewrite the slices that are spread over more than ``max_files`` files."""
    rows = spark.read.parquet(path)
    with scratch(spark):
        scattered = materialize(
            partition_stats(rows, slice_col).filter(F.col("file_count") > max_files).select(slice_col),
            "scattered-slices",
        )
        if not scattered.isEmpty():
            replace_slices(_in_slices(rows, scattered, slice_col), path, slice_col)


def file_bins(files: DataFrame, slice_col: str, target_bytes: int) -> DataFrame:
    """The files of slices worth compacting (two or more files under half the target), each with the ``bin`` its rows go to.

    A file of half the target or more keeps a bin to itself.  Small files follow one another, and a bin is full when the
    files before have reached the next multiple of the target: each but the last of a slice holds between half and
    three halves of it, so only that one is small afterwards.
    """
    small = F.col("bytes") * 2 < target_bytes
    in_order = Window.partitionBy(slice_col).orderBy("file_path")
    before = F.sum(F.when(small, F.col("bytes")).otherwise(0)).over(in_order) - F.when(small, F.col("bytes")).otherwise(0)
    n_small = F.sum(small.cast("int")).over(Window.partitionBy(slice_col))
    shared = F.concat(F.lit("small-"), F.floor(before / target_bytes).cast("string"))
    return files.withColumn("_n", n_small).withColumn("bin", F.when(small, shared).otherwise(F.col("file_path"))).filter(
        "_n > 1").drop("_n")


def compact_by_size(spark: SparkSession, path: str, slice_col: str, target_bytes: int = 256 << 20) -> None:
    """Merge small files of a slice up to ``target_bytes``; slices with one small file at most are left alone, so a second
    run writes nothing, however large the slices are.

    Files are packed into bins by their bytes and the rows of a bin go to one task, a slice's folder being replaced as a
    whole.  What is stored in between is one row per file.
    """
    rows = spark.read.parquet(path)
    with scratch(spark):
        bins = materialize(file_bins(file_stats(rows, slice_col), slice_col, target_bytes), "file-bins")
        if bins.isEmpty():
            return
        listed = bins.select(F.col("file_path").alias("_file"), "bin")
        names = rows.columns
        packed = rows.withColumn("_path", F.col("_metadata.file_path")).join(listed, F.col("_path") == F.col("_file"))
        n = bins.select(slice_col, "bin").distinct().count()
        (packed.repartition(n, slice_col, "bin").select(*names).write.partitionBy(slice_col)
         .mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))
