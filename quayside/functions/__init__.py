"""Column -> Column expressions, all built in and code-generated on the JVM."""

from .dates import (
    conform_date,
    date_to_day_of_year_key,
    date_to_key,
    epoch,
    key_to_date,
    next_day_key,
    parse_date,
    slice_date,
    slice_key,
    today_key,
)
from .labels import either, first_match, is_reefer, presence_flag
from .text import null_to_blank, remove_symbols, replace_pairs, sanitize

__all__ = [
    "conform_date", "date_to_day_of_year_key", "date_to_key", "either", "epoch", "first_match",
    "is_reefer", "key_to_date", "next_day_key", "null_to_blank", "parse_date", "presence_flag",
    "remove_symbols", "replace_pairs", "sanitize", "slice_date", "slice_key", "today_key",
]
