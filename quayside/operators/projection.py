"""Choosing, naming and typing columns, and the filters that go with them.

Every multi-column change is one ``select``; Catalyst sees one projection and prunes through it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import conform_date, slice_date
from ..functions.dates import NO_DATE, NO_DATE_TEXT
from ..settings import materialize


def project(df: DataFrame, columns: Sequence[str] | T.StructType) -> DataFrame:
    """Exactly these columns in this order."""
    names = columns.names if isinstance(columns, T.StructType) else columns
    return df.select(*names)


def align(df: DataFrame, other: DataFrame) -> DataFrame:
    """The columns of ``df`` in the order ``other`` has them."""
    return df.select(*other.columns)


def rename_with_suffix(df: DataFrame, suffix: str, columns: Iterable[str] | None = None) -> DataFrame:
    """``COMPANY`` -> ``COMPANY_m`` for the given columns, or for all."""
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in columns or df.columns})


def rename_by_pairs(df: DataFrame, source: Sequence[str], target: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(source, target, strict=True)))


def select_by_pattern(df: DataFrame, pattern: str, exclude: bool = False) -> DataFrame:
    """Columns whose name contains (or, with ``exclude``, does not contain) the pattern."""
    return df.select(*[c for c in df.columns if bool(re.search(pattern, c)) != exclude])


def stamp(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns, such as ``ETL_DATE=20231001``."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def transform_exprs(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """``(column, SQL expression)`` pairs in order; a later one may use an earlier one."""
    return reduce(lambda d, pair: d.withColumn(pair[0], F.expr(pair[1])), pairs, df)


def trim_all_strings(df: DataFrame) -> DataFrame:
    """Strip spaces (only spaces) off every string column."""
    return df.select(*[
        F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _typed(df: DataFrame, field: T.StructField) -> tuple[Column, Column]:
    """A column trimmed and cast to its contract's type, and whether its text could not be read."""
    is_text = isinstance(df.schema[field.name].dataType, T.StringType)
    value = F.trim(F.col(field.name)) if is_text else F.col(field.name)
    if not isinstance(field.dataType, T.DateType):
        typed = value.try_cast(field.dataType)
        return typed, value.isNotNull() & typed.isNull()
    if is_text:
        return conform_date(value), value.isNotNull() & (value != NO_DATE_TEXT) & slice_date(value).isNull()
    return F.coalesce(value.cast("date"), F.lit(NO_DATE).cast("date")), F.lit(False)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Untyped text to a typed contract: trim, cast, sentinel dates and column order without a
    shuffle.  What cannot be cast becomes NULL, a date that cannot be read 1900-12-31.

    Date texts are read as one array.  Written out for each column, in one method with all other columns, their
    code passes the size up to which the JVM compiles a method, and is interpreted.
    """
    dates = [f.name for f in schema.fields
             if isinstance(f.dataType, T.DateType) and isinstance(df.schema[f.name].dataType, T.StringType)]
    typed = {f.name: _typed(df, f)[0] for f in schema.fields if f.name not in dates}
    if dates:
        held = "_dates" + "_" * max(map(len, schema.names))  # no column of the contract
        texts = F.array(*[F.trim(F.col(c)) for c in dates])
        df = df.select(*[value.alias(c) for c, value in typed.items()], F.transform(texts, conform_date).alias(held))
        typed = {c: F.col(c) for c in typed} | {c: F.col(held)[i] for i, c in enumerate(dates)}
    return df.select(*[typed[c].alias(c) for c in schema.names])


def conform_rejects(df: DataFrame, schema: T.StructType, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that conform without a failed cast, and for each failed cast of the others its row, column and raw text.

    One pass casts and keeps what failed; it is stored, and both parts are read from there.  A row is in exactly
    one part, so the typed rows and the rows named in the rejects add up to the input.  ``keys`` are the input's columns
    that name a row; rejects carry them as they came, with ``reject_row`` to tell rows of one key apart, and
    ``reject_column`` and ``reject_text``.  Missing values and the source's "no date" are no failures.
    """
    typed = {f.name: _typed(df, f) for f in schema.fields}
    failed = F.filter(F.array(*[
        F.when(bad, F.struct(F.lit(name).alias("reject_column"), F.col(name).cast("string").alias("reject_text")))
        for name, (_, bad) in typed.items()]), lambda x: x.isNotNull())
    wide = materialize(df.select(
        F.struct(*keys).alias("_keys"), F.monotonically_increasing_id().alias("reject_row"), failed.alias("_failed"),
        F.struct(*[value.alias(name) for name, (value, _) in typed.items()]).alias("_row")), "conformed")
    rows = wide.filter(F.size("_failed") == 0).select("_row.*")
    rejects = wide.select("_keys.*", "reject_row", F.explode("_failed").alias("_f")).select(
        *keys, "reject_row", "_f.reject_column", "_f.reject_text")
    return rows, rejects


def keys_not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with all keys present (stated as IS NOT NULL, which scans understand)."""
    return df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def distinct_rows(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Exact copies collapse; copies are folded before the shuffle, so many of one row are cheap."""
    return df.dropDuplicates() if enabled else df


def one_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the largest by ``latest_by`` and, among equals, by the remaining columns.

    An aggregate rather than a row number: rows of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    if not rest and not latest_by:
        return df.dropDuplicates()
    best = F.max(F.struct(*latest_by, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*[
        F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns
    ])
