"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.numbering import global_row_id
from ..settings import Scratch, materialize


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """``materialize``, and then let Spark drop the shuffle files that led there."""
    df = materialize(df, name, **options)
    drop_shuffles(df.sparkSession)
    return df


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans no longer held.

    Spark's cleaner drops them once the driver's memory is collected, which a driver with little to do
    may put off for half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Return freed memory to the system; called at the end of a task.

    Spark keeps a Python worker for later tasks and stages, and Arrow's pool and the C library keep what
    they once had: without this each stage of a pipeline would add its peak to that of the one before.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(work: Callable) -> Callable:
    """``work`` over the batches of a task, which then gives back what it freed."""

    def run(batches):
        yield from work(batches)
        give_back()

    return run


def by_batch(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` for work that looks at one batch at a time."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(tidy(run), schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()],
        names=list(columns),
    )


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def in_row(docs: DataFrame) -> DataFrame:
    """All columns as the struct ``row``, so that no helper column can clash with one of them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def numbered(docs: DataFrame, files: Scratch, id_col: str = "doc_id") -> tuple[DataFrame, bool]:
    """``row`` and ``key``, a number that names a row and orders it by its id; and whether ids alone could not.

    If all ids are there and different they are the keys.  Else rows are stored once and numbered, those without an
    id last, so rows that share an id or have none are documents of their own.
    """
    whole, own = in_row(docs), F.col(f"row.`{id_col}`").cast("long")
    keyed = whole.withColumn("key", own)
    if keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1 or key is null").isEmpty():
        return keyed, False
    rows = files.keep(whole.withColumn("at", F.monotonically_increasing_id()), "rows")
    order = ["none", "id", "at"]
    numbers = global_row_id(rows.select(own.isNull().alias("none"), own.alias("id"), "at"), order, "key", tie_break=())
    return rows.join(files.keep(numbers.select("at", "key"), "numbers"), "at").select("row", "key"), True
