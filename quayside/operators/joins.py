"""Enriching facts from keyed, conditional and validity-dated lookup tables.

No broadcast hints: a lookup here can be a 25-row code table or one row per container, and only
its measured size may decide.  Spark broadcasts a side below its threshold (from statistics, or
at run time under AQE) and otherwise sorts and merges, splitting partitions of hot keys on the
fact side of inner and left joins.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import presence_flag
from .projection import one_per_key

Pairs = Sequence[tuple[str, str]]


def _condition(on: Pairs | Column, left: str, right: str) -> Column:
    if isinstance(on, Column):
        return on
    return reduce(and_, [F.col(f"{left}.{a}") == F.col(f"{right}.{b}") for a, b in on])


def shuffled_anew(left: DataFrame, right: DataFrame, on: Pairs) -> Column:
    """Key equality for joining to a side that was just aggregated by the same keys.

    Such a side is already partitioned by the keys and would be joined as it is; Spark then
    cannot split a hot key of the other side, for it splits only what was shuffled for the join
    itself.  The keys' hash as a further key changes no match and makes it shuffle the aggregated
    (small) side again.  Equal values of different types, and 0.0 and -0.0, hash differently: such
    keys are left plain.
    """
    plain = _condition(on, "src", "lookup")
    types = [(left.schema[a].dataType, right.schema[b].dataType) for a, b in on]
    if any(a != b or isinstance(a, (T.FloatType, T.DoubleType)) for a, b in types):
        return plain
    hashes = [F.xxhash64(*[F.col(f"src.{a}") for a, _ in on]),
              F.xxhash64(*[F.col(f"lookup.{b}") for _, b in on])]
    return plain & (hashes[0] == hashes[1])


def enrich(
    src: DataFrame,
    lookup: DataFrame,
    on: Pairs | Column,
    take: Sequence[str],
    suffix: str = "",
    how: str = "left",
    keep: Sequence[str] | None = None,
    unique: bool = False,
    aggregated: bool = False,
) -> DataFrame:
    """Add ``take`` columns of ``lookup`` (as ``<column>_<suffix>``) to ``src``.

    ``on`` is a list of (source column, lookup column) or a condition over ``src.*`` and
    ``lookup.*``.  A key that occurs twice in the lookup doubles the source row; ``unique=True``
    reduces the lookup to one row per key first.  Say ``aggregated`` of a lookup that is already
    the result of grouping by its keys.
    """
    if unique:
        keys = list(dict.fromkeys(b for _, b in on))
        lookup = one_per_key(lookup.select(*dict.fromkeys([*keys, *take])), keys)
    if unique or aggregated:
        on = shuffled_anew(src, lookup, on)
    kept = [F.col(f"src.{c}") for c in keep] if keep else [F.col("src.*")]
    taken = [F.col(f"lookup.{c}").alias(f"{c}_{suffix}" if suffix else c) for c in take]
    joined = src.alias("src").join(lookup.alias("lookup"), _condition(on, "src", "lookup"), how)
    return joined.select(*kept, *taken)


@dataclass(frozen=True)
class Lookup:
    """One step of :func:`enrich_chain`."""

    table: DataFrame
    on: Pairs | Column
    take: Sequence[str]
    suffix: str = ""
    how: str = "left"
    where: Column | None = None
    unique: bool = False


def enrich_chain(src: DataFrame, lookups: Iterable[Lookup]) -> DataFrame:
    """Enrich from several lookups in turn; later conditions may use earlier columns."""

    def step(df: DataFrame, look: Lookup) -> DataFrame:
        table = look.table if look.where is None else look.table.filter(look.where)
        return enrich(df, table, look.on, look.take, look.suffix, look.how, unique=look.unique)

    return reduce(step, lookups, src)


def code_table_lookup(
    src: DataFrame, codes: DataFrame, code_type: str, column: str, suffix: str = "sys"
) -> DataFrame:
    """Description of ``column`` among the codes of one type."""
    of_type = codes.filter(F.col("CODE_TP") == code_type)
    return enrich(src, of_type, [(column, "CODE_REF")], ["DESCR"], suffix)


def existence_join(src: DataFrame, other: DataFrame, on: Pairs, once: bool = False) -> DataFrame:
    """Source rows that have a match.  A source row comes once per match, or just once."""
    if not once:
        return enrich(src, other, on, [], how="inner")
    keys, pairs = _distinct_keys(other, on)
    return src.alias("src").join(keys.alias("lookup"), shuffled_anew(src, keys, pairs), "left_semi")


def without_keys_of(df: DataFrame, other: DataFrame, on: Pairs) -> DataFrame:
    """Rows of ``df`` that match none of ``other``."""
    keys, pairs = _distinct_keys(other, on)
    return df.alias("src").join(keys.alias("lookup"), shuffled_anew(df, keys, pairs), "left_anti")


def _distinct_keys(other: DataFrame, on: Pairs) -> tuple[DataFrame, Pairs]:
    """The keys alone and once each: what a semi or anti join looks at is then free of hot keys."""
    keys = other.select(*[F.col(b).alias(f"_other_{i}") for i, (_, b) in enumerate(on)]).distinct()
    return keys, [(a, f"_other_{i}") for i, (a, _) in enumerate(on)]


def flag_exists(
    src: DataFrame, keys: DataFrame, on: Pairs, flag: str, unique: bool = False
) -> DataFrame:
    """'Y' or blank, by whether ``keys`` holds the row's key."""
    marker = on[0][1]
    found = enrich(src, keys, on, [marker], "found", unique=unique)
    return found.select(
        *[F.col(c) for c in src.columns], presence_flag(F.col(f"{marker}_found")).alias(flag)
    )


def full_outer(left: DataFrame, right: DataFrame, on: Pairs, suffix: str) -> DataFrame:
    """All rows of both sides, the right side's columns under ``suffix``.  NULL keys match nothing.

    A left join plus what is on the right only.  Spark cannot split a hot key in a full outer
    join; it can on the left of each of these two, and the keys opposite are distinct.
    """
    matched = enrich(left, right, on, right.columns, suffix)
    unmatched = without_keys_of(right, left, [(b, a) for a, b in on])
    return matched.unionByName(
        unmatched.withColumnsRenamed({c: f"{c}_{suffix}" for c in right.columns}),
        allowMissingColumns=True,
    )


@dataclass(frozen=True)
class Buckets:
    """Cuts the time axis for :func:`validity_join`: ``days`` wide between two dates.

    Everything before ``first`` or after ``last`` falls into the outermost buckets, so the
    choice of dates decides only how evenly the work spreads and never what matches.
    """

    days: int
    first: str
    last: str

    def of(self, day: Column) -> Column:
        def index(d: Column) -> Column:
            return F.floor(F.datediff(d, F.lit(self.first).cast("date")) / self.days)

        top = index(F.lit(self.last).cast("date"))
        return F.least(F.greatest(index(day), F.lit(0)), top)


def validity_join(
    src: DataFrame,
    windows: DataFrame,
    on: Pairs,
    at: str,
    valid: tuple[str, str],
    take: Sequence[str],
    suffix: str = "",
    when: Column | None = None,
    buckets: Buckets | None = None,
) -> DataFrame:
    """Left join to the windows that are valid on the row's day, both ends included.

    ``when`` is a condition over ``src.*``: rows failing it stay, unmatched.  Windows that
    overlap each give a row.  With ``buckets`` the join key is (key, time bucket): for keys with
    very many windows this compares a row to the windows of its time only, and it spreads one
    hot key over as many tasks as there are buckets.
    """
    start, end = valid
    facts, periods = src, windows.select(*dict.fromkeys([*[b for _, b in on], start, end, *take]))
    span = [F.col(f"src.{at}") >= F.col(f"lookup.{start}"), F.col(f"src.{at}") <= F.col(f"lookup.{end}")]
    if buckets is not None:
        facts = src.withColumn("_bucket", buckets.of(F.col(at)))
        # a window that ends before it starts covers no day and must not be exploded
        periods = periods.filter(F.col(start) <= F.col(end)).withColumn(
            "_bucket", F.explode(F.sequence(buckets.of(F.col(start)), buckets.of(F.col(end))))
        )
        span.append(F.col("src._bucket") == F.col("lookup._bucket"))
    condition = reduce(and_, span, _condition(on, "src", "lookup"))
    if when is not None:
        condition = condition & when
    joined = enrich(facts, periods, condition, take, suffix)
    return joined.drop("_bucket") if buckets is not None else joined


def validity_join_by_role(
    src: DataFrame,
    windows: DataFrame,
    role: str,
    roles: Mapping[str, tuple[str, str]],
    key: str,
    at: str,
    valid: tuple[str, str],
    take: Sequence[str],
    buckets: Buckets | None = None,
) -> DataFrame:
    """One validity table used in several roles, of which a row plays at most one.

    ``roles`` maps a value of column ``role`` to (source key column, suffix).  Since the values
    exclude each other the key to look up is a CASE over ``role``: one join serves all roles,
    where one join per role would move the facts that many times.
    """
    which = [(F.col(role) == value, column) for value, (column, _) in roles.items()]
    wanted = F.coalesce(*[F.when(test, F.col(column)) for test, column in which])
    joined = validity_join(
        src.withColumn("_key", wanted), windows, [("_key", key)], at, valid, take, "_hit",
        buckets=buckets,
    )
    taken = [
        F.when(F.col(role) == value, F.col(f"{c}__hit")).alias(f"{c}_{suffix}")
        for value, (_, suffix) in roles.items()
        for c in take
    ]
    return joined.select(*src.columns, *taken)
