"""Row-level comparison of two versions of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def copy_counts(stored: DataFrame, source: DataFrame) -> DataFrame:
    """Every distinct row with its number of copies on either side (``_stored``, ``_source``).

    One aggregate over both sides does the work of two set differences, treats NULLs as equal,
    and folds copies before the shuffle, so a row repeated a billion times stays one row per task.
    """
    columns = stored.columns
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = stored.select(*columns, one.alias("_stored"), none.alias("_source")).unionByName(
        source.select(*columns, none.alias("_stored"), one.alias("_source"))
    )
    return both.groupBy(*columns).agg(
        F.sum("_stored").alias("_stored"), F.sum("_source").alias("_source")
    )


# how the copies stored and at the source must compare for a row to count as a difference
DIFFERS = {
    "removed": lambda stored, source: (stored > 0) & (source == 0),
    "symmetric": lambda stored, source: (stored > 0) != (source > 0),
    "copies": lambda stored, source: stored != source,
}


def diff_rows(stored: DataFrame, source: DataFrame, mode: str = "symmetric") -> DataFrame:
    """Rows that make the two sides differ.

    ``removed``: stored but no longer at the source.  ``symmetric``: on one side only.
    ``copies``: also rows on both sides, a different number of times.
    """
    return copy_counts(stored, source).filter(DIFFERS[mode](F.col("_stored"), F.col("_source")))


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not hold; NULL equals NULL."""
    return diff_rows(left, right, "removed").select(*left.columns)


def is_changed(stored: DataFrame, source: DataFrame, mode: str = "symmetric") -> bool:
    """Does anything differ?  Stops at the first difference found."""
    return not diff_rows(stored, source, mode).isEmpty()
