"""Session settings the operators count on, and the shared folder they write to."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings worth having on any session that runs these loads.  They are Spark defaults or
#: close to it; the caller owns the session, nothing here is applied behind its back.
SESSION_CONF = {
    # joins on hot keys: split the oversized shuffle partitions at run time
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # writes: the REBALANCE hint splits a hot slice and packs the small ones together
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # without a zone of its own a date key would depend on where the driver runs
    "spark.sql.session.timeZone": "UTC",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return named.rstrip("/")


#: paths written in each open scratch block, the innermost last
_open: list[list[str]] = []


class Scratch:
    """What an open block may keep."""

    def __init__(self, own: list[str]):
        self._own = own

    def keep(self, df, name: str):
        """Store ``df`` past the end of the block (an outer block may still remove it)."""
        df = materialize(df, name)
        path = self._own.pop()
        if len(_open) > 1:
            _open[-2].append(path)
        return df


@contextmanager
def scratch(spark: SparkSession):
    """Whatever ``materialize`` writes inside the block is removed when it ends, kept frames aside."""
    own: list[str] = []
    _open.append(own)
    try:
        yield Scratch(own)
    finally:
        _open.remove(own)
        for path in own:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/quayside/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str, **options):
    """Write ``df`` to the shared folder and read it back.

    Used where a result is read more than once and must be the same each time: lineage ends
    at the written files, so a lost executor costs a re-read and never a different answer.
    Parquet rather than ``checkpoint()`` because later steps then read only their columns.
    ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if _open:
        _open[-1].append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, most: int):
    """What runs inside the block sends Python workers Arrow batches of about ``most`` bytes, a row at least.

    Spark holds such a batch twice outside its heap, the worker once.  The session's own setting comes back when the
    block ends, and stays if it is smaller.
    """
    before = spark.conf.get(_BATCH_BYTES)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) > most:
        spark.conf.set(_BATCH_BYTES, f"{most}b")
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


def cut_lineage(df):
    """``checkpoint()`` into the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
