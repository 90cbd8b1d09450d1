"""Headway regularity, scheduled and observed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timepoint.functions.columns import computed_once
from timepoint.functions.timeofday import gtfs_seconds, service_hour, time_band
from timepoint.operators.reliability import in_some_band
from timepoint.settings import Settings


def operating_gaps(gaps: DataFrame, cap_min: float) -> DataFrame:
    """Gaps that are service, not simultaneous departures or breaks."""
    return gaps.filter((F.col("headway_min") > 0) & (F.col("headway_min") <= cap_min))


def successive_gaps(
    events: DataFrame,
    time_col: str,
    extra_keys: Sequence[str] = (),
    settings: Settings = Settings(),
) -> DataFrame:
    """Minutes between successive events per (route, stop, *extra keys).

    Events at the same second give zero gaps, which are not headways, so equal times are
    collapsed first. That leaves the gaps unchanged and bounds every window by the seconds
    of a service day: a stop with a third of all events is reduced map-side before the
    ordering shuffle.
    """
    keys = ["route_id", "stop_id", *extra_keys]
    times = events.select(*keys, time_col).distinct()
    previous = F.lag(time_col).over(Window.partitionBy(*keys).orderBy(time_col))
    gaps = times.withColumn("previous", previous).filter(F.col("previous").isNotNull())
    minutes = (F.col(time_col) - F.col("previous")) / F.lit(60.0)
    return operating_gaps(
        gaps.withColumn("headway_min", minutes), settings.headway_gap_cap_min
    )


def _banded(events: DataFrame, settings: Settings) -> DataFrame:
    band = time_band(service_hour(F.col("sched_sec")), settings.time_bands)
    return in_some_band(events.withColumn("time_band", band))


def scheduled_events(
    stop_times: DataFrame, trips: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    timed = computed_once(
        stop_times.select("trip_id", "stop_id", "arrival_time"),
        sched_sec=gtfs_seconds(F.col("arrival_time")),
    )
    return _banded(timed.drop("arrival_time"), settings).join(trips.select("trip_id", "route_id"), "trip_id")


def headway_scheduled(
    stop_times: DataFrame, trips: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Mean and spread of scheduled headway per route x band (the calendar is not applied)."""
    events = scheduled_events(stop_times, trips, settings)
    return (
        successive_gaps(events, "sched_sec", ["time_band"], settings)
        .groupBy("route_id", "time_band")
        .agg(
            F.avg("headway_min").alias("sched_headway_mean_min"),
            F.stddev_samp("headway_min").alias("sched_headway_sd_min"),
            F.count(F.lit(1)).alias("n_headways"),
        )
    )


def headway_vs_schedule(
    observed: DataFrame, scheduled: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Observed spread against the scheduled mean; NULL when either is unknown."""
    target = scheduled.select("route_id", "time_band", "sched_headway_mean_min")
    regular = F.col("obs_headway_sd_min") <= settings.headway_bar * F.col("sched_headway_mean_min")
    return observed.join(target, ["route_id", "time_band"], "left").withColumn(
        "headway_regular", regular.cast("int")
    )


def headway_observed(
    delays: DataFrame, scheduled: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Spread of observed headway per route x date x band (all matches, no outlier cut)."""
    gaps = successive_gaps(
        _banded(delays, settings), "inferred_sec", ["service_date", "time_band"], settings
    )
    observed = gaps.groupBy("route_id", "service_date", "time_band").agg(
        F.stddev_samp("headway_min").alias("obs_headway_sd_min"),
        F.count(F.lit(1)).alias("n_obs"),
    )
    return headway_vs_schedule(observed, scheduled, settings)
