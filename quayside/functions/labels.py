"""Flags and labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from .text import BLANK

# What the third character of an ISO size-type code is for a refrigerated box.
REEFER_GROUPS = ("3", "4", "R")


def presence_flag(key: Column) -> Column:
    """'Y' if a left join found a row, blank if not."""
    return F.when(key.isNull(), F.lit(BLANK)).otherwise(F.lit("Y"))


def is_reefer(iso: Column) -> Column:
    return F.when(F.substring(iso, 3, 1).isin(*REEFER_GROUPS), F.lit("Y")).otherwise(F.lit(BLANK))


def either(test: Column, then: Column, otherwise: Column) -> Column:
    """``then`` where the test is true; ``otherwise`` where it is false or unknown."""
    return F.when(test, then).otherwise(otherwise)


def first_match(cases: Iterable[tuple[Column, str]], otherwise: str = BLANK) -> Column:
    """Label of the first test that is true."""
    tests = list(cases)
    label = F.when(tests[0][0], F.lit(tests[0][1]))
    for test, text in tests[1:]:
        label = label.when(test, F.lit(text))
    return label.otherwise(F.lit(otherwise))
