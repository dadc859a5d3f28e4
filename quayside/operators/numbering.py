"""Consecutive numbers over a whole table, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..settings import materialize, scratch
from .joins import without_keys_of
from .projection import keys_not_null

# monotonically_increasing_id() puts the partition above bit 33 and counts rows below it
_PARTITION_SHIFT = 33
_POSITION_MASK = (1 << _PARTITION_SHIFT) - 1


def global_row_id(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "ROW_ID",
    tie_break: Sequence[str] | None = None,
    start_after: int = 0,
) -> DataFrame:
    """``row_number() over (order by order_by)`` computed in parallel.

    Rows are range-partitioned and sorted by the order columns, positions within a range come
    for free, and each range starts where the ones before it end.  ``tie_break`` names columns
    that, with ``order_by``, tell all rows apart; they make the numbers deterministic and let a
    range boundary fall inside a key that holds a large part of all rows.  Without it, the rows are
    written out first and all other columns are used, then a row's file and position, which tell
    whole copies apart: a range may end among the copies of one row.

    The ranged rows are written out before they are counted: range bounds come from a sample,
    so counting and numbering must look at the same files, not at two runs of the same plan.
    """
    with scratch(df.sparkSession) as kept:
        rows = df
        if tie_break is None:
            place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
            rows = materialize(df, "unnumbered").select("*", *place)
            tie_break = [c for c in rows.columns if c not in order_by]
        keys = [*order_by, *tie_break]
        ranged = kept.keep(
            rows.repartitionByRange(*keys)
            .sortWithinPartitions(*keys)
            .select(*df.columns, F.monotonically_increasing_id().alias(name)),
            "row-id",
        )
    part = F.shiftright(name, _PARTITION_SHIFT)
    # one row per range: as few rows as there are shuffle partitions, whatever the data
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    position = F.col(name).bitwiseAND(F.lit(_POSITION_MASK))
    number = F.col("_start") + position + F.lit(start_after + 1)
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*df.columns, number.cast("bigint").alias(name))
    )


def surrogate_keys(
    new_rows: DataFrame,
    dim: DataFrame,
    id_col: str,
    order_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Number new dimension rows on from the highest id in use."""
    highest = dim.agg(F.max(id_col)).first()[0] or 0
    return global_row_id(new_rows, order_by, id_col, tie_break, start_after=int(highest))


def register_keys(
    registry: DataFrame, rows: DataFrame, keys: Sequence[str], id_col: str
) -> DataFrame:
    """The registry of natural keys and their ids, with numbers for the keys it does not know yet.

    Ids are never given twice or anew: a dimension rebuilt from nothing and joined to its registry gets the ids it
    had, also for keys that were gone for a while.  New keys go on from the highest id in key order.  Rows with a NULL in
    the key have no id.  ``registry`` has the columns ``keys`` and ``id_col`` and holds a key once.
    """
    pairs = [(k, k) for k in keys]
    asked = keys_not_null(rows, keys).select(*keys).distinct()
    added = surrogate_keys(without_keys_of(asked, registry, pairs), registry, id_col, keys, tie_break=())
    return registry.select(*keys, id_col).unionByName(added.select(*keys, id_col))
