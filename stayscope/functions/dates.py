"""Timestamp expressions. All values are ``timestamp_ntz``, so no session zone matters."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stayscope import schemas

_SECOND_FORMAT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"


def timestamp_lit(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def open_end() -> Column:
    return timestamp_lit(schemas.OPEN_END)


def unset_index() -> Column:
    return timestamp_lit(schemas.UNSET_INDEX)


def undated() -> Column:
    return timestamp_lit(schemas.UNDATED)


def parse_timestamp(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a timestamp; anything else, blanks included, is null."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_SECOND_FORMAT), trimmed.try_cast("timestamp_ntz"))


def parse_mixed_timestamp(text: Column) -> Column:
    """Like :func:`parse_timestamp`, but a bare ten-character date means midnight."""
    trimmed = F.trim(text)
    padded = F.when(F.length(trimmed) == 10, F.concat(trimmed, F.lit(" 00:00:00"))).otherwise(
        trimmed
    )
    return parse_timestamp(padded)


def first_date(*candidates: Column, default: Column) -> Column:
    """The first known date of a fallback chain, else ``default``."""
    return F.coalesce(*candidates, default)


def full_days(later: Column, earlier: Column) -> Column:
    """Distance in whole 24-hour days, truncated, sign ignored."""
    return F.extract(F.lit("DAY"), F.abs(later - earlier))


def full_years(later: Column, earlier: Column) -> Column:
    """Distance in whole 365-day years (no leap days), as a double."""
    return F.floor(full_days(later, earlier) / 365).cast("double")


def plus_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def plus_days(ts: Column, days: int) -> Column:
    return ts + F.make_dt_interval(F.lit(days))
