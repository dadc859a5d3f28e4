"""Dates as text, as integer keys and as epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# How the source writes a day, the text it uses for "no date", and the day
# that stands for "no date" in typed tables.
SLICE_FORMAT = "dd-MMM-yy"
NO_DATE_TEXT = "31-DEC-00"
NO_DATE = "1900-12-31"

#: day spellings tried in order by :func:`parse_date`
DAY_FORMATS = (
    "yyyyMMdd",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd-MMM-yy",
    "dd MMM yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
)


_MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
_DAYS, _YEARS = [f"{d:02d}" for d in range(1, 32)], [f"{y:02d}" for y in range(100)]
#: ``-AUG-`` -> ``-08-``
_MONTH_PARTS = {f"-{name}-": f"-{i:02d}-" for i, name in enumerate(_MONTHS, 1)}


def slice_key(day: Column) -> Column:
    """A day the way the source spells it: ``31-AUG-23``.

    Put together from listed parts, which costs a fraction of a formatter's time.
    """
    year = F.abs(F.year(day)) % 100
    listed = (_DAYS, F.dayofmonth(day) - 1), (_MONTH_PARTS, F.month(day) - 1), (_YEARS, year)
    return F.concat(*[F.get(F.array(*map(F.lit, texts)), nth) for texts, nth in listed])


def slice_date(text: Column) -> Column:
    """``31-AUG-23`` -> 2023-08-31, as ``try_to_date`` with the source's format has it: NULL for any other text.

    The text is turned into an ISO date and cast, which costs a fraction of a formatter's time.
    """
    months = F.create_map(*[F.lit(part) for pair in _MONTH_PARTS.items() for part in pair])
    month = F.try_element_at(months, F.upper(F.substring(text, 3, 5)))
    iso = F.concat(F.lit("20"), F.substring(text, 8, 2), month, F.substring(text, 1, 2))
    return F.when(text.rlike(r"^[0-9]{2}-.{3}-[0-9]{2}\z"), iso.try_cast("date"))


def conform_date(text: Column) -> Column:
    """Source text to a date that is never NULL: missing, ``31-DEC-00`` and malformed text
    all become 1900-12-31."""
    dated = F.when(text != NO_DATE_TEXT, slice_date(text))
    return F.coalesce(dated, F.lit(NO_DATE).cast("date"))


def parse_date(text: Column, formats: Sequence[str] = DAY_FORMATS, strict: bool = False) -> Column:
    """First format that fits wins.  ``strict`` fails the job on text that fits none."""
    parsed = F.coalesce(*[F.try_to_date(text, f) for f in formats])
    if not strict:
        return parsed
    unreadable = text.isNotNull() & parsed.isNull()
    return F.when(unreadable, F.raise_error(F.concat(F.lit("not a date: "), text))).otherwise(parsed)


def key_to_date(key: Column) -> Column:
    """20230831 -> 2023-08-31; NULL where the number is no day."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def date_to_key(day: Column) -> Column:
    """2023-08-31 -> 20230831"""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_to_day_of_year_key(day: Column) -> Column:
    """2024-01-05 -> 2024005: year and three-digit day of year."""
    return F.year(day) * 1000 + F.dayofyear(day)


def next_day_key(key: Column) -> Column:
    """``'20231231'`` -> ``'20240101'``"""
    return F.date_format(F.date_add(F.try_to_date(key, "yyyyMMdd"), 1), "yyyyMMdd")


def today_key(zone: str = "Asia/Bangkok", at: Column | None = None) -> Column:
    """The day in ``zone`` as ``yyyyMMdd``: the current one, or that of a moment (UTC, without a zone)."""
    local = (
        F.convert_timezone(None, F.lit(zone), F.localtimestamp()) if at is None
        else F.convert_timezone(F.lit("UTC"), F.lit(zone), at.cast("timestamp_ntz")))
    return F.date_format(local, "yyyyMMdd")


def epoch(local: Column, zone: str = "Asia/Ho_Chi_Minh", millis: bool = True) -> Column:
    """Wall-clock time in ``zone`` -> milliseconds (or seconds) since 1970 UTC, rounded half
    to even.  Goes through zone-less timestamps so that the session zone has no say in it."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), local.cast("timestamp_ntz"))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", start, utc)
    return F.bround(micros / F.lit(1_000 if millis else 1_000_000)).cast("bigint")
