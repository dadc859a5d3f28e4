"""Counting and configured group-by; all partial on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

METHODS = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "count_distinct": F.count_distinct,
}


def count_rows(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def group_measures(
    df: DataFrame,
    group_by: Sequence[str],
    measures: Sequence[tuple[str, str, str]],
    where: Column | None = None,
) -> DataFrame:
    """``measures`` are (method, column, alias)."""
    kept = df if where is None else df.filter(where)
    aggs = [METHODS[method](F.col(column)).alias(alias) for method, column, alias in measures]
    return kept.groupBy(*group_by).agg(*aggs)


def group_by_filter(
    df: DataFrame,
    group_by: Sequence[str],
    filter_col: str,
    filter_keys: Sequence[str],
    measures: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """The configured form: keep rows whose ``filter_col`` is one of ``filter_keys``."""
    return group_measures(df, group_by, measures, F.col(filter_col).isin(*filter_keys))
