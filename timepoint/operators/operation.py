"""Confirmed-operation floor: scheduled trips that left a live trace."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.functions.timeofday import calendar_date_int, weekday_column
from timepoint.settings import Settings
from timepoint.sources.gtfs import WEEKDAYS


def active_services(calendar: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """(service_id, service_date) for every study date a service runs on.

    Every calendar row lists its own dates from a fixed array, so no join is needed.
    Calendar exceptions are not read, as in the published figures.
    """
    flag = F.create_map(*(x for d in WEEKDAYS for x in (F.lit(d), F.col(d))))
    start, end = F.col("start_date"), F.col("end_date")
    listed = F.array(*(F.lit(d) for d in sorted(dates)))

    def runs(date):
        day = calendar_date_int(date)
        return (flag[weekday_column(date)] == 1) & (start <= day) & (end >= day)

    return calendar.select(
        "service_id", F.explode(F.filter(listed, runs)).alias("service_date")
    )


def scheduled_trip_days(
    calendar: DataFrame, trips: DataFrame, dates: Sequence[dt.date]
) -> DataFrame:
    """(service_date, trip_id, route_id) of every trip scheduled on each date."""
    return trips.join(active_services(calendar, dates), "service_id").select(
        "service_date", "trip_id", "route_id"
    )


def scheduled_left_confirmed(scheduled: DataFrame, delays: DataFrame) -> DataFrame:
    """Scheduled trip-days with 1 when at least one position matched, else 0."""
    seen = delays.select("service_date", "trip_id").distinct().withColumn("confirmed", F.lit(1))
    return scheduled.join(seen, ["service_date", "trip_id"], "left").fillna(0, ["confirmed"])


def _counts() -> list:
    return [F.count(F.lit(1)).alias("scheduled"), F.sum("confirmed").alias("confirmed")]


def _rate(df: DataFrame) -> DataFrame:
    rate = F.round(F.try_divide("confirmed", "scheduled"), 4)
    return df.withColumn("avl_confirmed_rate", rate)


def operation_floor_by_day(checked: DataFrame) -> DataFrame:
    return _rate(checked.groupBy("service_date").agg(*_counts())).orderBy("service_date")


def operation_floor_by_operator(
    checked: DataFrame, routes: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Per operator, small operators left out.

    Counts are taken per route before the operator lookup, so the trip-days themselves are
    never joined and a busy route is combined map-side.
    """
    per_route = checked.groupBy("route_id").agg(*_counts())
    named = left_lookup_routes(per_route, routes)
    totals = named.groupBy("agency_id").agg(
        F.sum("scheduled").alias("scheduled"), F.sum("confirmed").alias("confirmed")
    )
    return _rate(totals.filter(F.col("scheduled") >= settings.min_operator_trips)).orderBy(
        F.desc("scheduled"), "agency_id"
    )


def left_lookup_routes(df: DataFrame, routes: DataFrame) -> DataFrame:
    return df.join(routes.select("route_id", "agency_id"), "route_id", "left")


def operation_floor_total(checked: DataFrame) -> DataFrame:
    """One row of totals; the rate is NULL when nothing was scheduled."""
    return checked.agg(
        F.count(F.lit(1)).alias("total_scheduled_trip_days"),
        F.coalesce(F.sum("confirmed"), F.lit(0)).alias("total_avl_confirmed"),
    ).withColumn(
        "overall_avl_confirmed_rate",
        F.round(F.try_divide("total_avl_confirmed", "total_scheduled_trip_days"), 4),
    )
