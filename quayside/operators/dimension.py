"""Slowly changing dimensions: find what a feed changes, then apply it as type 1 or type 2.

The feed is joined once; its outcome is a change set of inserted (I), updated (U) and deleted
(D) rows.  Applying works on the whole set by key, there is no statement per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..settings import materialize
from .joins import existence_join, without_keys_of
from .numbering import surrogate_keys
from .projection import distinct_rows, keys_not_null

# Version columns of a dimension, their states, and the open end.
STATUS, VALID_FROM, VALID_TO = "TRANG_THAI_BG", "NGAY_HL_BG", "NGAY_HH_BG"
ACTIVE, CLOSED = "A", "C"
OPEN_END = "2099-01-01"


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(STATUS) == ACTIVE)


def split_changes(
    dim: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    id_col: str,
    attributes: Sequence[str],
    deletes: bool = False,
    keep_unchanged: bool = False,
    drop_duplicates: bool = True,
) -> DataFrame:
    """What ``feed`` does to ``dim``: ``_change``, id, keys and attributes.

    I: key not in the dimension, id NULL.  U: key present, an attribute differs (NULL equals
    NULL); carries the id and the new attributes.  D, with ``deletes``: dimension row whose key
    the feed no longer has; carries the old attributes.  Rows with a NULL key take no part.

    A left join plus an anti join against the distinct feed keys, instead of one full outer
    join: a key the feed repeats endlessly then sits on the splittable side of the left join,
    and is folded to one row before the other.
    """
    columns = [*keys, *attributes]
    stored = keys_not_null(dim, keys).select(id_col, *columns)
    fed = distinct_rows(keys_not_null(feed, keys).select(*columns), drop_duplicates)

    match = reduce(and_, [F.col(f"fed.{k}") == F.col(f"stored.{k}") for k in keys])
    same = reduce(
        and_, [F.col(f"fed.{a}").eqNullSafe(F.col(f"stored.{a}")) for a in attributes], F.lit(True)
    )
    found = F.col("stored._found").isNotNull()
    change = F.when(~found, "I").when(same, "=").otherwise("U").alias("_change")
    changes = (
        fed.alias("fed")
        .join(stored.withColumn("_found", F.lit(True)).alias("stored"), match, "left")
        .select(change, F.col(f"stored.{id_col}").alias(id_col), *[F.col(f"fed.{c}") for c in columns])
    )
    if not keep_unchanged:
        changes = changes.filter(F.col("_change") != "=")
    if deletes:
        gone = without_keys_of(stored, fed, [(k, k) for k in keys])
        changes = changes.unionByName(gone.withColumn("_change", F.lit("D")))
    return changes


def of_kind(changes: DataFrame, *kinds: str) -> DataFrame:
    return changes.filter(F.col("_change").isin(*kinds)).drop("_change")


def apply_type1(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    id_col: str,
    attributes: Sequence[str],
) -> DataFrame:
    """Overwrite attributes in place and add new rows.  Columns the feed does not carry keep
    their value, and are NULL in new rows.  ``changes`` holds a key once."""
    updates = of_kind(changes, "U").select(
        id_col, F.lit(True).alias("_updated"), *[F.col(a).alias(f"_new_{a}") for a in attributes]
    )

    def value(c: str) -> Column:
        if c not in attributes:
            return F.col(c)
        return F.when(F.col("_updated"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    kept = dim.join(updates, id_col, "left").select(*[value(c) for c in dim.columns])
    added = surrogate_keys(of_kind(changes, "I").drop(id_col), dim, id_col, keys, tie_break=())
    return kept.unionByName(added, allowMissingColumns=True)


def apply_type2(
    dim: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    id_col: str,
    effective_date: str,
) -> DataFrame:
    """Close the versions that changed or vanished and open the new ones on ``effective_date``.

    ``changes`` holds a key once, or a key would get two active versions.  Closed history passes through untouched and unshuffled; only active rows are joined.
    """
    day = F.lit(effective_date).cast("date")
    ended = of_kind(changes, "U", "D").select(id_col).distinct().withColumn("_ended", F.lit(True))
    history = dim.filter(~F.col(STATUS).eqNullSafe(F.lit(ACTIVE)))
    active = (
        current_rows(dim)
        .join(ended, id_col, "left")
        .withColumns({
            STATUS: F.when(F.col("_ended"), F.lit(CLOSED)).otherwise(F.col(STATUS)),
            VALID_TO: F.when(F.col("_ended"), day).otherwise(F.col(VALID_TO)),
        })
        .select(*dim.columns)
    )
    opened = of_kind(changes, "I", "U").drop(id_col)
    opened = surrogate_keys(opened, dim, id_col, keys, tie_break=()).withColumns({
        STATUS: F.lit(ACTIVE),
        VALID_FROM: day,
        VALID_TO: F.lit(OPEN_END).cast("date"),
    })
    return history.unionByName(active).unionByName(opened, allowMissingColumns=True)


def apply_backdated(
    dim: DataFrame, late: DataFrame, keys: Sequence[str], id_col: str, attributes: Sequence[str], date_col: str,
) -> DataFrame:
    """Work facts that arrive late into the timelines of their keys (type 2).

    A late row says what a key's attributes were from ``date_col`` on, up to the next change known.  The version that holds
    this day is cut there: it is shortened, and the rest of it gets the late attributes and an id of its own.  On the first
    day of a version the late row takes its place and keeps its id.  Before the first version, or where there was none, it
    opens one up to the next.  Neighbours that come out equal (NULL equals NULL) become one version with the id of the
    first.  So no key gets gaps it did not have, and none gets overlaps; a version is active if it is open.

    Rows without key or date take no part; late rows that disagree on a day are an error.  Only the timelines of
    keys that have late rows are shuffled; a timeline has a version a day at most.  Columns besides keys and attributes
    stay with their version and are NULL in versions a late row opens.
    """
    fed = keys_not_null(late, [*keys, date_col]).select(
        *keys, F.col(date_col).cast("date").alias(VALID_FROM), *attributes).distinct()
    twice = fed.groupBy(*keys, VALID_FROM).count().filter("count > 1").select(*keys, VALID_FROM).first()
    if twice:
        raise ValueError(f"late rows of one key and day disagree: {twice.asDict()}")
    pairs = [(k, k) for k in keys]
    known = existence_join(dim, fed.select(*keys).distinct(), pairs, once=True)
    fixed = {id_col, *keys, STATUS, VALID_FROM, VALID_TO}
    held = F.struct(*[c for c in dim.columns if c not in fixed])  # NULL: the key has no version from here on
    empty = F.lit(None).cast(dim.select(held.alias("h")).schema["h"].dataType)
    no_id = F.lit(None).cast(dim.schema[id_col].dataType)
    new = F.struct(*[
        F.col(f.name) if f.name in attributes else F.lit(None).cast(f.dataType).alias(f.name)
        for f in dim.select(held.alias("h")).schema["h"].dataType.fields])
    events = (
        known.select(*keys, VALID_FROM, F.lit(1).alias("_rank"), F.col(id_col).alias("_id"), held.alias("_held"))
        .unionByName(known.filter(F.col(VALID_TO) < F.lit(OPEN_END).cast("date")).select(
            *keys, F.col(VALID_TO).alias(VALID_FROM), F.lit(0).alias("_rank"), no_id.alias("_id"), empty.alias("_held")))
        .unionByName(fed.select(*keys, VALID_FROM, F.lit(2).alias("_rank"), no_id.alias("_id"), new.alias("_held")))
    )
    # of what happens on one day the late row counts, then a version's start, then another's end
    days = events.groupBy(*keys, VALID_FROM).agg(
        F.max("_id").alias("_id"), F.max_by(F.struct("_held"), "_rank").alias("_now"))
    order = Window.partitionBy(*keys).orderBy(VALID_FROM)
    before = F.lag("_now").over(order)
    here, there = (F.struct(*[F.col(f"{side}._held.{a}") for a in attributes]) for side in ("_now", "_was"))
    gone = lambda side: F.col(f"{side}._held").isNull()
    starts = F.col("_was").isNull() | (gone("_now") != gone("_was")) | (~gone("_now") & ~here.eqNullSafe(there))
    pieces = (
        days.withColumn("_was", before).filter(starts)
        .withColumn(VALID_TO, F.coalesce(F.lead(VALID_FROM).over(order), F.lit(OPEN_END).cast("date")))
        .filter(~gone("_now"))
        .withColumn(STATUS, F.when(F.col(VALID_TO) == F.lit(OPEN_END).cast("date"), F.lit(ACTIVE)).otherwise(F.lit(CLOSED)))
    )
    pieces = materialize(pieces.select("_id", *keys, VALID_FROM, VALID_TO, STATUS, "_now._held.*"), "timelines")
    old = pieces.filter("_id is not null").withColumnRenamed("_id", id_col)
    added = surrogate_keys(pieces.filter("_id is null").drop("_id"), dim, id_col, [*keys, VALID_FROM], tie_break=())
    rest = without_keys_of(dim, fed, pairs)
    columns = dim.columns
    return rest.select(*columns).unionByName(old.select(*columns)).unionByName(added.select(*columns))
