"""Text clean-up."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Fixed value: what the reports print for "nothing".
BLANK = " "


def null_to_blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(BLANK))


def remove_symbols(text: Column, symbols: str, replacement: str = "") -> Column:
    """Replace every character of the class ``symbols`` (``'"``, ``0-9``, ``\\[\\]`` ...)."""
    return F.regexp_replace(text, f"[{symbols}]", replacement)


def replace_pairs(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Apply ``(find, put)`` replacements one after the other."""
    for find, put in pairs:
        text = F.replace(text, F.lit(find), F.lit(put))
    return text


def sanitize(message: Column) -> Column:
    """An error text without quotes, fit for the run log."""
    return remove_symbols(message, "'\"")
