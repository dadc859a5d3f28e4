"""Measures by surrogate key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .aggregate import METHODS
from .dimension import STATUS, current_rows
from .joins import enrich
from .projection import keys_not_null

UNKNOWN_ID = -1
# methods whose partial results can be combined by the second method named
_COMBINE = {"sum": "sum", "count": "sum", "min": "min", "max": "max"}


@dataclass(frozen=True)
class DimensionKey:
    """Replace natural key columns of the fact by the id of the matching dimension row."""

    dim: DataFrame
    on: Sequence[tuple[str, str]]
    id_col: str
    name: str


def fact_surrogate_lookup(
    src: DataFrame,
    dimensions: Sequence[DimensionKey],
    group_by: Sequence[str],
    measures: Sequence[tuple[str, str, str]],
) -> DataFrame:
    """Group by dimension ids (unknown: -1) and ``group_by``; measures are (method, column, alias).

    Facts are first aggregated by their natural keys.  What goes through the lookups is one row
    per key combination, so a hot key has shrunk to a few rows before anything is joined.
    """
    if not all(method in _COMBINE for method, _, _ in measures):
        raise ValueError(f"measures must be one of {sorted(_COMBINE)}")
    natural = list(dict.fromkeys([*group_by, *[a for d in dimensions for a, _ in d.on]]))
    facts = src.groupBy(*natural).agg(
        *[METHODS[method](F.col(column)).alias(alias) for method, column, alias in measures]
    )
    for d in dimensions:
        keys = [b for _, b in d.on]
        # current versions; one id per key, or the measure would count once per row of the dimension
        versions = current_rows(d.dim) if STATUS in d.dim.columns else d.dim
        ids = keys_not_null(versions, keys).groupBy(*keys).agg(F.min(d.id_col).alias(d.name))
        facts = enrich(facts, ids, d.on, [d.name], aggregated=True)
    names = [d.name for d in dimensions]
    facts = facts.withColumns({n: F.coalesce(F.col(n), F.lit(UNKNOWN_ID).cast("bigint")) for n in names})
    return facts.groupBy(*group_by, *names).agg(
        *[METHODS[_COMBINE[method]](F.col(alias)).alias(alias) for method, _, alias in measures]
    )
