"""The parameter table and the daily high-water mark in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import next_day_key

# Columns of the parameter table, and the key of the high-water mark.
KEY, VALUE = "MA_THAM_SO", "GIA_TRI"
WATERMARK = "ETL_DATE"


def param_lookup(params: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Trimmed key and value, one row per key asked for that exists."""
    trimmed = params.select(F.trim(KEY).alias(KEY), F.trim(VALUE).alias(VALUE))
    return trimmed.filter(F.col(KEY).isin(*keys)).groupBy(KEY).agg(F.max(VALUE).alias(VALUE))


def param_values(params: DataFrame, keys: Sequence[str]) -> dict[str, str]:
    """The same as a dict; at most one row per key comes to the driver."""
    return {row[KEY]: row[VALUE] for row in param_lookup(params, keys).collect()}


def advance_watermark(params: DataFrame, end: str, key: str = WATERMARK) -> DataFrame:
    """Move the high-water mark on by a day, unless it stands on ``end``."""
    value = F.trim(VALUE)
    due = (F.trim(KEY) == key) & (value != end)
    return params.withColumn(VALUE, F.when(due, next_day_key(value)).otherwise(F.col(VALUE)))
