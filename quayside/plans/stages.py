"""Raw text -> typed stage -> day-stamped summary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, types as T

from ..contracts import stamped
from ..operators.projection import conform, project, stamp, transform_exprs
from ..sources.writers import replace_slice


def conform_stage(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The typed stage table for a raw slice: one projection, no shuffle."""
    return conform(raw, schema)


def summary_rows(
    stage: DataFrame,
    schema: T.StructType,
    day: int,
    transforms: Iterable[tuple[str, str]] = (),
    column: str = "ETL_DATE",
) -> DataFrame:
    """Stage rows stamped with the load day, computed columns added, in contract order."""
    return project(transform_exprs(stamp(stage, **{column: day}), transforms), stamped(schema, column))


def summary_load(
    stage: DataFrame,
    path: str,
    schema: T.StructType,
    day: int,
    transforms: Iterable[tuple[str, str]] = (),
    column: str = "ETL_DATE",
) -> None:
    """Make the stage rows the summary's slice of ``day``; other days are not touched or read."""
    replace_slice(summary_rows(stage, schema, day, transforms, column), path, column, day)
