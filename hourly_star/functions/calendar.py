"""Local wall clock and calendar parts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _zone(zone: str | Column) -> Column:
    return F.lit(zone) if isinstance(zone, str) else zone


def local_time(ts: Column, zone: str | Column) -> Column:
    """Wall clock at `zone` for an instant, without a zone of its own."""
    return F.convert_timezone(F.lit("UTC"), _zone(zone), ts.cast("timestamp_ntz"))


def utc_instant(local: Column, zone: str | Column) -> Column:
    """The instant at which a wall clock reading happens at `zone`."""
    return F.convert_timezone(_zone(zone), F.lit("UTC"), local.cast("timestamp_ntz"))


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def iso_day_of_week(day: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(day) + 1


def is_weekend(day: Column, weekend: Iterable[int] | Column) -> Column:
    """Whether a day is one of the given ISO days of the week."""
    if isinstance(weekend, Column):
        return F.array_contains(weekend, iso_day_of_week(day))
    return iso_day_of_week(day).isin(list(weekend))


def padded_name(day: Column, pattern: str, padding: bool = True) -> Column:
    """English month or day name; padded to nine characters unless told not to."""
    name = F.date_format(day, pattern)
    return F.rpad(name, 9, " ") if padding else name


def hours_in_local_day(day: Column, zone: str | Column) -> Column:
    """24, except on the days the clock is changed."""
    start = utc_instant(day, zone)
    end = utc_instant(F.date_add(day, 1), zone)
    return F.timestamp_diff("HOUR", start, end).cast("int")
