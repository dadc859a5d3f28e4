"""One load day from source to summary, and on to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..contracts import untyped
from ..functions import key_to_date, slice_key
from ..operators.params import WATERMARK, advance_watermark, param_values
from ..operators.slices import slice_filter
from ..sources.readers import read_or_empty
from ..sources.writers import land_slices
from .stages import conform_stage, summary_load


def source_day(spark, day: str) -> str:
    """``20230831`` as the source spells it: ``31-AUG-23``."""
    return spark.range(1).select(slice_key(key_to_date(F.lit(day)))).first()[0]


def load_day(
    source: DataFrame,
    raw_path: str,
    summary_path: str,
    schema: T.StructType,
    day: str,
    slice_col: str = "EXEC_TS",
    mode: str = "copies",
) -> None:
    """Land the day's slice if it changed, conform it, and make it the summary's slice of the day.

    Each step replaces exactly one slice, so a load that failed half-way is simply run again.
    """
    key = source_day(source.sparkSession, day)
    land_slices(slice_filter(source, slice_col, key), raw_path, slice_col, mode, days=[key])
    raw = slice_filter(read_or_empty(source.sparkSession, raw_path, untyped(schema)), slice_col, key)
    summary_load(conform_stage(raw, schema), summary_path, schema, int(day))


def load_next_day(
    source: DataFrame,
    raw_path: str,
    summary_path: str,
    schema: T.StructType,
    params: DataFrame,
    end: str,
    slice_col: str = "EXEC_TS",
) -> DataFrame:
    """Load the day the high-water mark stands on; the parameter table with the mark moved on."""
    day = param_values(params, [WATERMARK])[WATERMARK]
    load_day(source, raw_path, summary_path, schema, day, slice_col)
    return advance_watermark(params, end)
