"""From stop delays to trip, route x band x day and travel-time facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timepoint.functions.columns import discover_columns
from timepoint.functions.delays import on_time_flags
from timepoint.functions.timeofday import day_name, service_hour, time_band
from timepoint.settings import Settings


def lower_median(name: str) -> Column:
    """Exact lower (discrete) median.

    Safe for delays: they are whole hundredths of a minute within half a day, so the
    aggregate's value-count map is bounded however many rows a group holds.
    """
    return F.expr(f"percentile_disc(0.5) within group (order by {name})")


def drop_outliers(delays: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return delays.filter(F.abs("delay_min") <= settings.max_abs_delay_min)


def outlier_summary(delays: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row: stop events before and after the cut, and the share dropped."""
    keep = F.abs("delay_min") <= settings.max_abs_delay_min
    return delays.agg(
        F.count(F.lit(1)).alias("raw_events"), F.count_if(keep).alias("kept_events")
    ).withColumn(
        "dropped_share",
        F.coalesce(1.0 - F.try_divide("kept_events", "raw_events"), F.lit(0.0)),
    )


def trip_rollup(delays: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per (trip, route, date) with on-time flags, hour, band and weekday."""
    grouped = drop_outliers(delays, settings).groupBy("trip_id", "route_id", "service_date")
    rolled = grouped.agg(
        lower_median("delay_min").alias("median_delay"),
        F.count(F.lit(1)).alias("stops_observed"),
        F.min("sched_sec").alias("first_sched_sec"),
    )
    hour = service_hour(F.col("first_sched_sec"))
    return rolled.select(
        "*",
        *on_time_flags(F.col("median_delay"), settings.on_time_windows),
        hour.alias("hour"),
        time_band(hour, settings.time_bands).alias("time_band"),
        day_name(F.col("service_date")).alias("day_of_week"),
    )


def in_some_band(df: DataFrame) -> DataFrame:
    return df.filter(F.col("time_band").isNotNull())


def route_band_day(trips: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Compliance label per route x time band x service day."""
    keys = ("route_id", "service_date", "time_band", "day_of_week")
    facts = in_some_band(trips).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_trips"),
        F.avg(settings.primary_flag).alias("pct_on_time"),
        F.avg("median_delay").alias("mean_trip_delay"),
        F.stddev_samp("median_delay").alias("sd_trip_delay"),
    )
    meets = F.col("pct_on_time") >= settings.compliance_bar
    return facts.withColumn("compliant", meets.cast("int"))


def compliance_share(facts: DataFrame) -> DataFrame:
    """One row: band-days, compliant band-days, and their share (0 rows gives 0.0)."""
    return facts.agg(
        F.count(F.lit(1)).alias("band_days"),
        F.count_if(F.col("compliant") == 1).alias("compliant_band_days"),
    ).withColumn(
        "compliant_share",
        F.coalesce(F.try_divide("compliant_band_days", "band_days"), F.lit(0.0)),
    )


def trip_durations(
    delays: DataFrame, settings: Settings = Settings(), per_day: bool = False
) -> DataFrame:
    """First to last observed stop, in minutes, of trips seen at enough stops.

    All dates of a trip are pooled by default, as published; ``per_day`` separates them.
    """
    keys = ["trip_id", "route_id"] + (["service_date"] if per_day else [])
    span = (F.max("inferred_sec") - F.min("inferred_sec")) / F.lit(60.0)
    return (
        drop_outliers(delays, settings)
        .groupBy(*keys)
        .agg(span.alias("actual_dur_min"), F.count(F.lit(1)).alias("stops_seen"))
        .filter((F.col("stops_seen") >= settings.ttv_min_stops) & (F.col("actual_dur_min") > 0))
    )


def travel_time_variability(durations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Coefficient of variation of trip duration per route against the bar."""
    per_route = durations.groupBy("route_id").agg(
        F.avg("actual_dur_min").alias("mean_dur_min"),
        F.stddev_samp("actual_dur_min").alias("sd_dur_min"),
        F.count(F.lit(1)).alias("n_trips_measured"),
    )
    cv = F.col("sd_dur_min") / F.col("mean_dur_min")
    return per_route.select(
        "*", cv.alias("ttv_cv"), (cv <= settings.ttv_bar).cast("int").alias("ttv_ok")
    )


def sensitivity_windows(trips: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Compliance under every on-time window found in the trip facts, in one pass.

    The flags are averaged side by side in a single aggregate (one row per route, date and
    band) and only that small result is unpivoted, so the fact rows are never multiplied.
    """
    flags = sorted(discover_columns(trips.columns, prefix="on_time_"))
    per_band = in_some_band(trips).groupBy("route_id", "service_date", "time_band").agg(
        *(F.avg(flag).alias(flag) for flag in flags)
    )
    label = F.concat(F.lit("+/-"), F.element_at(F.split("flag", "_"), -1), F.lit(" min"))
    meets = (F.col("pct_on_time") >= settings.compliance_bar).cast("int")
    return (
        per_band.unpivot(["route_id"], flags, "flag", "pct_on_time")
        .groupBy(label.alias("window"))
        .agg(
            F.count(F.lit(1)).alias("band_days"),
            F.round(F.avg(meets), 4).alias("compliant_share"),
            F.round(F.avg("pct_on_time"), 4).alias("mean_on_time"),
        )
    )
