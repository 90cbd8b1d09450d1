"""Every tunable of the analysis in one immutable object.

Operators never read configuration files or globals: they take a ``Settings`` (or the one
scalar they need), so a study of another city is ``dataclasses.replace(Settings(), ...)``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class TimeBand:
    """Half-open band of service hours ``[first_hour, end_hour)``."""

    name: str
    first_hour: int
    end_hour: int


@dataclass(frozen=True)
class Box:
    """Geographic box in WGS84 degrees; all four sides are inclusive."""

    min_lat: float
    max_lat: float
    min_lon: float
    max_lon: float


# The study's published definitions.
DEFAULT_BOX = Box(53.55, 53.98, -2.20, -1.20)
DEFAULT_DATES = tuple(dt.date(2026, 7, d) for d in range(2, 9))
DEFAULT_BANDS = (
    TimeBand("am_peak", 7, 9),
    TimeBand("inter_peak", 9, 16),
    TimeBand("pm_peak", 16, 19),
    TimeBand("evening", 19, 23),
)
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


@dataclass(frozen=True)
class Settings:
    box: Box = DEFAULT_BOX
    study_dates: tuple[dt.date, ...] = DEFAULT_DATES
    train_days: int = 5
    zone: str = "Europe/London"

    # on-time definition (minutes) and the windows reported next to it
    on_time: tuple[int, int] = (-2, 2)
    sensitivity_minutes: tuple[int, ...] = (3, 5)
    compliance_bar: float = 0.85

    match_radius_m: float = 50.0
    max_abs_delay_min: float = 60.0
    time_bands: tuple[TimeBand, ...] = DEFAULT_BANDS

    headway_gap_cap_min: float = 180.0
    headway_bar: float = 0.2
    ttv_bar: float = 0.15
    ttv_min_stops: int = 3

    min_operator_trips: int = 100
    min_band_days_tested: int = 5
    min_band_days_ranked: int = 3
    min_stop_passes: int = 20
    region_stop_prefix: str = "450"

    def __post_init__(self) -> None:
        taken: set[int] = set()
        for band in self.time_bands:
            hours = set(range(band.first_hour, band.end_hour))
            if hours & taken:
                raise ValueError(f"time band {band.name} overlaps an earlier band")
            taken |= hours

    @property
    def on_time_windows(self) -> tuple[tuple[int, int], ...]:
        """Primary window first, then the symmetric sensitivity windows."""
        return (self.on_time, *((-m, m) for m in self.sensitivity_minutes))

    @property
    def primary_flag(self) -> str:
        return flag_name(*self.on_time)

    @property
    def band_order(self) -> tuple[str, ...]:
        return tuple(b.name for b in self.time_bands)

    @property
    def train_dates(self) -> tuple[dt.date, ...]:
        return tuple(sorted(self.study_dates)[: self.train_days])

    @property
    def test_dates(self) -> tuple[dt.date, ...]:
        return tuple(sorted(self.study_dates)[self.train_days :])


def flag_name(low: int, high: int) -> str:
    """Column name of an on-time flag, e.g. ``on_time_2_2``."""
    return f"on_time_{abs(low)}_{abs(high)}"
