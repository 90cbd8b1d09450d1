from __future__ import annotations

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from timepoint.functions import buckets, columns, delays, geo, timeofday
from timepoint.settings import Box, Settings, TimeBand, flag_name

BANDS = Settings().time_bands


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(*values):
    return [F.lit(v) for v in values]


def test_haversine_known_distances(spark):
    assert one(spark, geo.haversine_m(*lit(53.8, -1.55, 53.8, -1.55))) == 0.0
    degree = one(spark, geo.haversine_m(*lit(53.0, -1.55, 54.0, -1.55)))
    assert degree == pytest.approx(111_195, rel=0.01)
    assert one(spark, geo.haversine_m(*lit(53.8, -1.55, 53.8 + 15 / 111_320, -1.55))) < 50


@pytest.mark.parametrize(
    ("text", "expected"),
    [("25:30:00", 91_800), ("08:15:30", 29_730), (" 8:15:30", 29_730), ("8:15", None),
     ("x:00:00", None), (None, None), ("", None)],
)
def test_gtfs_seconds(spark, text, expected):
    assert one(spark, timeofday.gtfs_seconds(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    ("hour", "band"),
    [(8, "am_peak"), (13, "inter_peak"), (17, "pm_peak"), (21, "evening"), (3, None), (9, "inter_peak"), (23, None)],
)
def test_time_band(spark, hour, band):
    assert one(spark, timeofday.time_band(F.lit(hour), BANDS)) == band


def test_overlapping_bands_are_rejected():
    with pytest.raises(ValueError):
        Settings(time_bands=(TimeBand("a", 7, 10), TimeBand("b", 9, 12)))


@pytest.mark.parametrize(
    ("observed", "scheduled", "expected"),
    [(36_180, 36_000, 180), (600, 86_700, 300), (86_280, 120, -240), (43_200, 0, 43_200),
     (0, 43_200, -43_200 + 86_400), (0, 3 * 86_400 + 60, -60)],
)
def test_wrap_delay(spark, observed, scheduled, expected):
    assert one(spark, delays.wrap_delay(F.lit(observed), F.lit(scheduled))) == expected


def test_local_seconds_follow_summer_time(spark):
    eight_utc = F.timestamp_seconds(F.lit(1_782_979_200))  # 2026-07-02T08:00:00Z
    assert one(spark, timeofday.local_seconds_of_day(eight_utc, "Europe/London")) == 9 * 3600
    winter = F.timestamp_seconds(F.lit(1_704_096_000))  # 2024-01-01T08:00:00Z
    assert one(spark, timeofday.local_seconds_of_day(winter, "Europe/London")) == 8 * 3600


def test_service_hour_passes_midnight(spark):
    assert one(spark, timeofday.service_hour(F.lit(91_800))) == 1


def test_calendar_helpers(spark):
    day = F.lit(dt.date(2024, 1, 6))
    assert one(spark, timeofday.day_name(day)) == "Saturday"
    assert one(spark, timeofday.weekday_column(day)) == "saturday"
    assert one(spark, timeofday.is_weekend(day)) == 1
    assert one(spark, timeofday.calendar_date_int(day)) == 20240106
    assert one(spark, timeofday.date_of_calendar_int(F.lit(20240106))) == dt.date(2024, 1, 6)
    assert one(spark, timeofday.date_of_calendar_int(F.lit(20241399))) is None
    assert one(spark, timeofday.iso_date_prefix(F.lit("2026-07-01T00:00:00Z"))) == dt.date(2026, 7, 1)
    assert one(spark, timeofday.iso_date_prefix(F.lit("soon"))) is None


@pytest.mark.parametrize(
    ("delay", "flags"), [(2.0, (1, 1, 1)), (2.01, (0, 1, 1)), (-5.0, (0, 0, 1)), (None, (None,) * 3)]
)
def test_on_time_flags_are_inclusive(spark, delay, flags):
    df = spark.createDataFrame([(delay,)], "d double")
    got = df.select(*delays.on_time_flags(F.col("d"), Settings().on_time_windows)).first()
    assert tuple(got) == flags
    assert got.__fields__ == ["on_time_2_2", "on_time_3_3", "on_time_5_5"]


def test_flag_name():
    assert flag_name(-2, 2) == "on_time_2_2"


def test_bbox_is_inclusive(spark):
    box = Box(53.0, 54.0, -2.0, -1.0)
    assert one(spark, geo.in_bbox(F.lit(53.0), F.lit(-1.0), box)) is True
    assert one(spark, geo.in_bbox(F.lit(52.999), F.lit(-1.0), box)) is False


@pytest.mark.parametrize(
    ("x", "label"), [(0, None), (1, "1-2"), (2, "1-2"), (3, "3-5"), (20, "11-20"), (21, "20+")]
)
def test_bucket_right_closed(spark, x, label):
    got = buckets.bucket_right_closed(F.lit(x), buckets.TRIP_EDGES, buckets.TRIP_LABELS)
    assert one(spark, got) == label


def test_bucket_include_lowest(spark):
    edges, labels = (0.0, 0.5, 1.0), (1, 2)
    assert one(spark, buckets.bucket_right_closed(F.lit(0.0), edges, labels, True)) == 1
    assert one(spark, buckets.bucket_right_closed(F.lit(0.0), edges, labels)) is None


def test_clip_keeps_null(spark):
    assert one(spark, buckets.clip(F.lit(25.0), -10.0, 20.0)) == 20.0
    assert one(spark, buckets.clip(F.lit(None).cast("double"), -10.0, 20.0)) is None


def test_status_class(spark):
    assert [one(spark, buckets.status_class(F.lit(x))) for x in (0.85, 0.6, 0.59)] == [
        "green", "orange", "red",
    ]


def test_fill_defaults_adds_and_fills(spark):
    df = spark.createDataFrame([(None, 2.0)], "a int, b double")
    assert columns.fill_defaults(df, {"a": -1, "c": 0.0}).first().asDict() == {
        "a": -1, "b": 2.0, "c": 0.0,
    }


def test_discovery():
    names = ["LSOA code (2011)", "Income Decile", "Index of Multiple Deprivation (IMD) Decile"]
    assert columns.discover_columns(names, "decile", "multiple deprivation") == [names[2]]
    assert columns.discover_pattern(names, r"lsoa.*code") == [names[0]]


def test_nan_and_refs(spark):
    assert one(spark, columns.nan_to_null(F.lit(float("nan")))) is None
    assert one(spark, columns.split_refs(F.lit(""))) == []
    assert one(spark, columns.split_refs(F.lit("a,b"))) == ["a", "b"]


def test_settings_split():
    s = dataclasses.replace(Settings(), train_days=5)
    assert len(s.train_dates) == 5 and len(s.test_dates) == 2
    assert max(s.train_dates) < min(s.test_dates)


@pytest.mark.parametrize("lat", [0.0, 53.8, -75.0, 89.9999])
def test_grid_cells_cover_the_circle(spark, lat):
    """Any point within the radius lies in a cell listed for the centre."""
    import math
    import random

    rng = random.Random(5)
    radius = 50.0
    grid = geo.Grid(radius)
    points = []
    for lon in (-1.5, 179.9999, -180.0):
        for _ in range(60):
            angle, r = rng.uniform(0, 2 * math.pi), radius * math.sqrt(rng.random())
            dlat = math.degrees(r * math.cos(angle) / geo.EARTH_RADIUS_M)
            dlon = math.degrees(
                r * math.sin(angle) / geo.EARTH_RADIUS_M / math.cos(math.radians(lat))
            )
            far = lon + dlon
            points.append((lat, lon, min(lat + dlat, 90.0), (far + 180) % 360 - 180))
    df = spark.createDataFrame(points, "lat double, lon double, plat double, plon double")
    x, y = grid.cell_of(F.col("plat"), F.col("plon"))
    cells = grid.cells_around(F.col("lat"), F.col("lon"))
    near = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")) <= radius
    listed = F.exists(cells, lambda c: (c["cell_x"] == x) & (c["cell_y"] == y))
    checked = df.filter(near).select(listed.alias("ok"))
    assert checked.count() > 50
    assert checked.filter("not ok").count() == 0
