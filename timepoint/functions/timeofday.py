"""Service-time and calendar column expressions.

None of these depends on the session time zone: instants are shifted explicitly and
everything else works on DATE, integers or text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from timepoint.settings import DAY_NAMES, TimeBand

SECONDS_PER_DAY = 86_400


def gtfs_seconds(hhmmss: Column) -> Column:
    """Seconds since the start of the service day; hours may pass 24; NULL if malformed."""
    parts = F.split(hhmmss, ":")

    def part(i: int) -> Column:
        return F.trim(F.get(parts, F.lit(i))).try_cast("int")

    return part(0) * 3600 + part(1) * 60 + part(2)


def local_seconds_of_day(instant: Column, zone: str) -> Column:
    """Wall-clock second of the day of a TIMESTAMP in ``zone``."""
    shifted = F.unix_seconds(F.from_utc_timestamp(instant, zone))
    return F.pmod(shifted, F.lit(SECONDS_PER_DAY)).cast("int")


def service_hour(seconds: Column) -> Column:
    """Clock hour 0..23 of a second-of-service-day that may exceed 24 h."""
    return (F.floor(seconds / F.lit(3600)) % 24).cast("int")


def time_band(hour: Column, bands: Sequence[TimeBand]) -> Column:
    """Name of the half-open band holding the hour, else NULL; the first match wins."""
    named: Column | None = None
    for band in bands:
        hit = (hour >= band.first_hour) & (hour < band.end_hour)
        named = F.when(hit, band.name) if named is None else named.when(hit, band.name)
    return F.lit(None).cast("string") if named is None else named


def day_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), F.weekday(date) + 1)


def is_weekend(date: Column) -> Column:
    return (F.weekday(date) >= 5).cast("int")


def weekday_column(date: Column) -> Column:
    """Calendar-file column name (``monday`` ... ``sunday``) of a date."""
    return F.lower(day_name(date))


def calendar_date_int(date: Column) -> Column:
    """DATE as the integer ``yyyymmdd`` calendar files use."""
    return F.year(date) * 10_000 + F.month(date) * 100 + F.dayofmonth(date)


def date_of_calendar_int(value: Column) -> Column:
    """Inverse of :func:`calendar_date_int`; NULL for impossible dates."""
    return F.try_to_date(value.cast("string"), "yyyyMMdd")


def iso_date_prefix(text: Column) -> Column:
    """DATE held in the first ten characters of an ISO-8601 string."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
