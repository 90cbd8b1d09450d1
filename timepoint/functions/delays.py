"""Delay arithmetic and on-time flags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from timepoint.functions.timeofday import SECONDS_PER_DAY
from timepoint.settings import flag_name

HALF_DAY = SECONDS_PER_DAY // 2


def wrap_delay(observed_sec: Column, scheduled_sec: Column) -> Column:
    """Observed minus scheduled, folded to the nearest day: (-43200, 43200].

    One modulo covers any number of whole days, so timetables past 24:00 compare
    correctly with wall-clock observations.
    """
    raw = observed_sec - scheduled_sec
    return F.pmod(raw + (HALF_DAY - 1), F.lit(SECONDS_PER_DAY)) - (HALF_DAY - 1)


def delay_minutes(seconds: Column) -> Column:
    return F.round(seconds / F.lit(60.0), 2)


def on_time_flags(delay: Column, windows: Iterable[tuple[int, int]]) -> list[Column]:
    """One 0/1 column per tolerance window, inclusive at both ends."""
    return [
        delay.between(float(low), float(high)).cast("int").alias(flag_name(low, high))
        for low, high in windows
    ]
