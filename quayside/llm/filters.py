"""Which keys are worth a shuffle: a filter of fixed size, and keys that occur more than once.

A filter says yes for every key it was made of and now and then for another, so it only saves work; what counts is
decided on the keys themselves afterwards, at every size in the same way.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

BITS = 27  # of the number of bits, at most: 16 MB
_SHIFTS = (0, 18)


def make_filter(keys: DataFrame, n: int, key: str = "key") -> np.ndarray:
    """A table of bits, three to a key (64 bits of hash): sixteen bits a key, up to 2**BITS."""
    size = min(BITS, max(10, (16 * n).bit_length()))
    spots = F.explode(F.array(*[
        F.shiftrightunsigned(key, s).bitwiseAND(F.lit((1 << size) - 1)) for s in (*_SHIFTS, 64 - size)]))
    words = keys.select(spots.alias("spot")).groupBy(F.shiftright("spot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(spot % 64 as int))")).alias("bits"))
    found = words.toArrow()  # 2**(size - 6) short rows at most
    out = np.zeros(1 << (size - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be among those the filter was made of."""
    size = len(table).bit_length() + 5
    out = np.ones(len(keys), bool)
    for s in (*_SHIFTS, 64 - size):
        spot = (keys >> np.uint64(s)) & np.uint64((1 << size) - 1)
        out &= (table[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return out


def looked_up(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi", take: tuple[str, ...] = ()) -> DataFrame:
    """The rows whose key is listed, with ``take`` from the list.  ``keys`` was aggregated by them: it is shuffled anew,
    by a hash besides, or Spark could not split the rows of a hot key."""
    listed = keys.select(*[F.col(c).alias(f"_{c}") for c in on], *take)
    same: Column = F.xxhash64(*[rows[c] for c in on]) == F.xxhash64(*[listed[f"_{c}"] for c in on])
    for c in on:
        same = same & (rows[c] == listed[f"_{c}"])
    return rows.join(listed, same, how).drop(*[f"_{c}" for c in on])


def repeated(rows: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key occurs in more than one of them."""
    return looked_up(rows, rows.groupBy(*on).agg(F.count("*").alias("n")).filter("n > 1"), on)


def after_first(rows: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    """The rows that are not the first of their key; whole copies of the first are it too."""
    place = F.struct(*order)
    first = rows.groupBy(*on).agg(F.min(place).alias("_first"), F.count("*").alias("n")).filter("n > 1")
    return looked_up(rows, first, on, "inner", ("_first",)).filter(F.struct(*[rows[c] for c in order]) != F.col("_first")).drop("_first")
