"""Day slices: the unit that is loaded, compared, replaced and re-run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .compare import DIFFERS, copy_counts


def slice_filter(df: DataFrame, column: str, day) -> DataFrame:
    """The rows of one day; prunes partitions when ``column`` is the partition column."""
    return df.filter(F.col(column) == F.lit(day))


def changed_slices(
    stored: DataFrame, source: DataFrame, slice_col: str, mode: str = "symmetric"
) -> DataFrame:
    """Slices of the source to be (re)written: not stored yet, or different from what is stored.

    All slices are compared in one aggregate.  A slice the source does not have is left alone.  Where copies count, a
    slice differs if its digest does, and no rows are shuffled (but those that nothing but ``GROUP BY`` can compare).
    """
    if mode == "copies" and not any(
        isinstance(f.dataType, NESTED) for df in (stored, source) for f in df.schema.fields
    ):
        return _changed_by_digest(stored, source, slice_col)
    counts = copy_counts(stored, source)
    n_stored, n_source = F.col("_stored"), F.col("_source")
    per_slice = counts.groupBy(slice_col).agg(
        F.max(n_stored).alias("_stored"),
        F.max(n_source).alias("_source"),
        F.max(DIFFERS[mode](n_stored, n_source)).alias("_differs"),
    )
    return per_slice.filter(
        (F.col("_source") > 0) & ((F.col("_stored") == 0) | F.col("_differs"))
    ).select(slice_col)


def _changed_by_digest(stored: DataFrame, source: DataFrame, slice_col: str) -> DataFrame:
    """Slices whose digests differ: one row per slice and task is shuffled, never a row of the tables."""
    columns = sorted(c for c in stored.columns if c != slice_col)
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = stored.select(*_quoted(stored.columns), one.alias("_stored"), none.alias("_source")).unionByName(
        source.select(*_quoted(stored.columns), none.alias("_stored"), one.alias("_source")))

    def net(seed: int) -> Column:
        value = _hashed(both, columns, seed).cast("decimal(20,0)")
        return F.sum(F.when(F.col("_source") == 1, value).otherwise(-value))

    per_slice = both.groupBy(slice_col).agg(
        F.sum("_stored").alias("_stored"), F.sum("_source").alias("_source"), net(1).alias("_one"), net(2).alias("_two"))
    return per_slice.filter(
        "_source > 0 AND (_stored <> _source OR _one <> 0 OR _two <> 0)").select(slice_col)


def _quoted(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


# ---- digests: what a slice holds, in three numbers ------------------------------------------------

#: types whose equal values need not have equal hashes
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.UserDefinedType)
DIGEST = ["n_rows", "sum_one", "sum_two"]


def _hashed(df: DataFrame, columns: list[str], seed: int) -> Column:
    """64 bits of hash of a row.  A NULL leaves Spark's hash as it was, so each column says whether it is one;
    0.0 and -0.0 are equal values and get one hash."""
    parts = []
    for c in columns:
        value = F.col(f"`{c}`")
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0).cast(df.schema[c].dataType)
        parts += [value, value.isNull()]
    return F.xxhash64(F.lit(seed), *parts)


def slice_digests(rows: DataFrame, slice_col: str) -> DataFrame:
    """One row per slice (NULL is one): its number of rows and the sums of two 64-bit hashes of them.

    Sums do not depend on the order of rows and count copies, so equal digests mean equal bags of rows but for a
    chance of 2**-64 and less.  One aggregate, folded before it is shuffled: a hot slice is one row a task.
    """
    columns = sorted(c for c in rows.columns if c != slice_col)
    total = lambda seed: F.sum(_hashed(rows, columns, seed).cast("decimal(20,0)"))
    return rows.groupBy(slice_col).agg(
        F.count("*").alias("n_rows"), total(1).alias("sum_one"), total(2).alias("sum_two"))


def latest_digests(log: DataFrame, slice_col: str) -> DataFrame:
    """The last digest logged for each slice."""
    last = F.max_by(F.struct(*DIGEST), "version")
    return log.groupBy(slice_col).agg(last.alias("_last")).select(slice_col, "_last.*")


def changed_digests(stored: DataFrame, source: DataFrame, slice_col: str) -> DataFrame:
    """The source's digests that differ from what is stored, or are of slices not stored yet."""
    was = stored.select(F.col(slice_col).alias("_slice"), *[F.col(c).alias(f"_{c}") for c in DIGEST])
    same = source[slice_col].eqNullSafe(was["_slice"])
    for c in DIGEST:
        same = same & source[c].eqNullSafe(was[f"_{c}"])
    return source.join(was, same, "left_anti")
