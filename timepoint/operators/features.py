"""Leakage-safe feature table for predicting compliance."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timepoint.functions.columns import fill_defaults
from timepoint.functions.timeofday import is_weekend, time_band
from timepoint.operators.reliability import in_some_band
from timepoint.settings import Settings

# The published label, model inputs and the outcome's own parts.
LABEL = "compliant"
CATEGORICAL = ("day_of_week", "time_band")
NUMERIC = (
    "n_stops",
    "n_trips",
    "precip_mm",
    "temp_c",
    "wind_kph",
    "route_imd_decile",
    "route_hist_ontime_rate",
    "is_weekend",
    "sched_headway_mean_min",
    "sched_headway_sd_min",
    "n_active_disruptions",
)
PRECURSORS = ("pct_on_time", "mean_trip_delay", "sd_trip_delay")

# What an unknown feature becomes. Temperature stays NULL.
DEFAULTS = {
    "precip_mm": 0.0,
    "wind_kph": 0.0,
    "n_stops": 0,
    "route_hist_ontime_rate": 0.0,
    "route_imd_decile": -1.0,
    "sched_headway_mean_min": 0.0,
    "sched_headway_sd_min": 0.0,
    "n_active_disruptions": 0,
}


def weather_by_band(weather: DataFrame, settings: Settings = Settings()) -> DataFrame:
    band = time_band(F.col("hour"), settings.time_bands)
    return (
        in_some_band(weather.withColumn("time_band", band))
        .groupBy("service_date", "time_band")
        .agg(*(F.avg(c).alias(c) for c in ("precip_mm", "temp_c", "wind_kph")))
    )


def time_split(df: DataFrame, train_dates: Sequence[dt.date]) -> DataFrame:
    """Add ``is_train``: 1 on the training dates, else 0."""
    return df.withColumn("is_train", F.col("service_date").isin(list(train_dates)).cast("int"))


def route_history_train_only(facts: DataFrame, train_dates: Sequence[dt.date]) -> DataFrame:
    """Mean on-time rate per route over training days; test days never contribute."""
    past = facts.filter(F.col("service_date").isin(list(train_dates)))
    return past.groupBy("route_id").agg(F.avg("pct_on_time").alias("route_hist_ontime_rate"))


def with_route_history(facts: DataFrame, train_dates: Sequence[dt.date]) -> DataFrame:
    """Facts with their route's training history, the facts being computed once.

    A route has at most one row per study date and band, so the window is small whatever
    the number of trips.
    """
    past = F.when(F.col("service_date").isin(list(train_dates)), F.col("pct_on_time"))
    history = F.avg(past).over(Window.partitionBy("route_id"))
    return facts.withColumn("route_hist_ontime_rate", history)


def assemble_features(facts: DataFrame, *tables: tuple[DataFrame | None, list[str]]) -> DataFrame:
    """Left-join feature tables on their keys; absent tables are skipped.

    Each table has one row per key, so no join adds rows. Sizes decide the strategy at run
    time; nothing is hinted.
    """
    for table, keys in tables:
        if table is not None:
            facts = facts.join(table, keys, "left")
    return facts


def feature_table(
    facts: DataFrame,
    n_stops: DataFrame,
    weather: DataFrame,
    route_areas: DataFrame,
    headways: DataFrame | None = None,
    disruptions: DataFrame | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """Route-band-days with everything knowable before the trips run, plus the split."""
    if headways is not None:
        headways = headways.drop("n_headways")
    joined = assemble_features(
        with_route_history(facts, settings.train_dates),
        (n_stops, ["route_id"]),
        (weather_by_band(weather, settings), ["service_date", "time_band"]),
        (route_areas.select("route_id", "route_imd_decile"), ["route_id"]),
        (headways, ["route_id", "time_band"]),
        (disruptions, ["route_id", "service_date"]),
    )
    flagged = joined.withColumn("is_weekend", is_weekend(F.col("service_date")))
    return fill_defaults(time_split(flagged, settings.train_dates), DEFAULTS)


def leakage_checks(features: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per rule with the number of violations found in the data or column lists."""
    train, test = F.col("is_train") == 1, F.col("is_train") == 0
    # one aggregate per route holds the dates, the stored history and its recomputation
    per_route = features.groupBy("route_id").agg(
        F.max(F.when(train, F.col("service_date"))).alias("last_train"),
        F.min(F.when(test, F.col("service_date"))).alias("first_test"),
        F.coalesce(F.avg(F.when(train, F.col("pct_on_time"))), F.lit(0.0)).alias("expected"),
        F.min("route_hist_ontime_rate").alias("lowest"),
        F.max("route_hist_ontime_rate").alias("highest"),
    )
    differs = (F.abs(F.col("lowest") - F.col("expected")) > 1e-6) | (
        F.abs(F.col("highest") - F.col("expected")) > 1e-6
    )
    leaked = [c for c in (*NUMERIC, *CATEGORICAL) if c in (LABEL, *PRECURSORS)]
    out_of_order = F.coalesce(F.max("last_train") >= F.min("first_test"), F.lit(False))
    found = per_route.agg(
        out_of_order.cast("long").alias("dates_ordered"),
        F.count_if(differs).alias("history_is_train_only"),
        F.lit(len(leaked)).cast("long").alias("outcome_not_a_feature"),
    )
    return found.unpivot([], found.columns, "rule", "violations")
