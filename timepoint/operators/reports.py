"""Report aggregates over the warehouse facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timepoint.functions.buckets import (
    RAIN_EDGES,
    RAIN_LABELS,
    bucket_right_closed,
    display_rank,
    pct_round,
    status_class,
)
from timepoint.operators.profile import exact_quantile
from timepoint.operators.statistics import per_route_compliance
from timepoint.settings import DAY_NAMES, Settings


def slice_filter(
    facts: DataFrame,
    dates: Sequence[dt.date] | None = None,
    bands: Sequence[str] | None = None,
) -> DataFrame:
    """Facts of the chosen dates and bands (None keeps all)."""
    if dates is not None:
        facts = facts.filter(F.col("service_date").isin(list(dates)))
    if bands is not None:
        facts = facts.filter(F.col("time_band").isin(list(bands)))
    return facts


def stop_slice(
    stops: DataFrame, min_events: int = 20, deciles: tuple[int, int] = (1, 10)
) -> DataFrame:
    """Stops with enough passes whose decile is in range or unknown."""
    decile = F.col("imd_decile")
    return stops.filter(
        (F.col("n_events") >= min_events) & (decile.between(*deciles) | decile.isNull())
    )


def having_min_support(df: DataFrame, column: str, at_least: int) -> DataFrame:
    return df.filter(F.col(column) >= at_least)


def star_join(facts: DataFrame, dim_route: DataFrame) -> DataFrame:
    return facts.join(dim_route, "route_id")


def _rates(per_route: DataFrame) -> DataFrame:
    return per_route.select(
        "route_id",
        (F.col("compliant_sum") / F.col("band_days")).alias("compliance_rate"),
        (F.col("on_time_sum") / F.col("band_days")).alias("mean_on_time"),
        "band_days",
        "trips",
    )


def worst_routes(
    facts: DataFrame, dim_route: DataFrame, limit: int = 10, settings: Settings = Settings()
) -> DataFrame:
    """Lowest compliance first, routes with enough band-days, ties by route id.

    Facts are reduced to one row per route before the dimension is joined.
    """
    enough = having_min_support(
        _rates(per_route_compliance(facts)), "band_days", settings.min_band_days_ranked
    )
    return (
        star_join(enough, dim_route.select("route_id", "route_short_name"))
        .select("route_id", "route_short_name", "compliance_rate", "band_days")
        .orderBy("compliance_rate", "route_id")
        .limit(limit)
    )


def routes_ranked(
    facts: DataFrame,
    dim_route: DataFrame,
    worst_first: bool = True,
    settings: Settings = Settings(),
) -> DataFrame:
    """All routes with enough band-days and their dimension columns, ordered."""
    enough = having_min_support(
        _rates(per_route_compliance(facts)), "band_days", settings.min_band_days_ranked
    )
    names = dim_route.select("route_id", "route_short_name", "operator", "route_imd_decile")
    rate = F.col("compliance_rate")
    return (
        enough.join(names, "route_id", "left")
        .orderBy(rate.asc() if worst_first else rate.desc(), "route_id")
        .select(
            "route_id",
            "route_short_name",
            "operator",
            F.round("route_imd_decile", 0).alias("imd_decile"),
            "band_days",
            "trips",
            pct_round(F.col("mean_on_time")).alias("on_time_pct"),
            pct_round(rate).alias("compliant_pct"),
        )
    )


def busiest_routes(fact_trip: DataFrame, dim_route: DataFrame, limit: int = 10) -> DataFrame:
    per_route = fact_trip.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("on_time").alias("on_time")
    )
    return (
        star_join(per_route, dim_route.select("route_id", "route_short_name"))
        .select("route_id", "route_short_name", "trips", "on_time")
        .orderBy(F.desc("trips"), "route_id")
        .limit(limit)
    )


def compliance_for_band(spark: SparkSession, facts: DataFrame, band: str) -> DataFrame:
    """Mean on-time rate per weekday of one band; the band is a bound parameter."""
    return spark.sql(
        """
        SELECT day_of_week, avg(pct_on_time) AS mean_on_time, count(*) AS n
        FROM {facts} WHERE time_band = :band
        GROUP BY day_of_week ORDER BY mean_on_time, day_of_week
        """,
        args={"band": band},
        facts=facts,
    )


def on_time_by_rain(features: DataFrame) -> DataFrame:
    rain = bucket_right_closed(F.col("precip_mm"), RAIN_EDGES, RAIN_LABELS)
    return (
        features.groupBy(rain.alias("rain"))
        .agg((F.avg("pct_on_time") * F.lit(100.0)).alias("on_time_pct"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("rain").isNotNull())
    )


def stop_reliability(
    delays: DataFrame,
    stops: DataFrame,
    stop_areas: DataFrame,
    settings: Settings = Settings(),
    min_passes: int | None = None,
) -> DataFrame:
    """On-time share, place, decile and status per stop with enough passes (all matches)."""
    low, high = settings.on_time
    inside = F.col("delay_min").between(float(low), float(high)).cast("double")
    per_stop = delays.groupBy("stop_id").agg(
        F.avg(inside).alias("on_time"), F.count(F.lit(1)).alias("n_events")
    )
    floor = settings.min_stop_passes if min_passes is None else min_passes
    return stop_dimension_joins(
        having_min_support(per_stop, "n_events", floor), stops, stop_areas
    ).withColumn("status", status_class(F.col("on_time")))


def stop_dimension_joins(
    per_stop: DataFrame, stops: DataFrame, stop_areas: DataFrame
) -> DataFrame:
    """Per-stop metrics with place (inner) and decile (left)."""
    return per_stop.join(
        stops.select("stop_id", "stop_name", "stop_lat", "stop_lon"), "stop_id"
    ).join(stop_areas.select("stop_id", "imd_decile"), "stop_id", "left")


def stop_map_kpis(shown: DataFrame, threshold: float = 0.85) -> DataFrame:
    return shown.agg(
        F.count(F.lit(1)).alias("stops_shown"),
        F.avg("on_time").alias("mean_on_time"),
        F.avg((F.col("on_time") >= threshold).cast("double")).alias("share_at_threshold"),
        F.coalesce(F.sum("n_events"), F.lit(0)).alias("matched_passes"),
    )


def worst_stops(shown: DataFrame, limit: int = 25) -> DataFrame:
    return (
        shown.orderBy("on_time", "stop_id")
        .limit(limit)
        .select("stop_id", "stop_name", pct_round(F.col("on_time")).alias("on_time_pct"), "n_events", "imd_decile")
    )


def band_day_pivot(facts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Percent of band-days compliant, band rows x weekday columns, in display order."""
    table = facts.groupBy("time_band").pivot("day_of_week", list(DAY_NAMES)).agg(F.avg("compliant"))
    return table.select(
        "time_band",
        *(pct_round(F.col(d)).alias(d) for d in DAY_NAMES),
        display_rank(F.col("time_band"), settings.band_order).alias("position"),
    ).orderBy("position")


def slice_kpis(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count(F.lit(1)).alias("band_days"),
        F.avg("compliant").alias("compliant_share"),
        F.avg("pct_on_time").alias("mean_on_time"),
    )


def ttv_headway_summary(ttv: DataFrame, observed: DataFrame) -> DataFrame:
    """One row: shares meeting the bars and the median duration CV.

    The median reads ``ttv`` several times (``profile.exact_quantile``): hand in a table.
    """
    routes = ttv.agg(F.avg("ttv_ok").alias("ttv_ok_share"))
    regular = observed.agg(F.avg("headway_regular"))
    return routes.select(
        regular.scalar().alias("headway_regular_share"),
        "ttv_ok_share",
        exact_quantile(ttv, "ttv_cv").scalar().alias("median_ttv_cv"),
    )


def overview_kpis(
    facts: DataFrame,
    trips: DataFrame,
    ttv: DataFrame,
    observed: DataFrame,
    operation_total: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """The headline numbers as one row; every part is a one-row aggregate."""

    def one(df: DataFrame, value: Column) -> Column:
        return df.agg(value).scalar()

    base = facts.agg(
        F.count(F.lit(1)).alias("band_days"), F.avg("compliant").alias("compliant_share")
    )
    return base.select(
        "band_days",
        one(trips, F.count(F.lit(1))).alias("trips_observed"),
        "compliant_share",
        one(trips, F.avg(settings.primary_flag)).alias("trips_on_time_share"),
        one(observed, F.avg("headway_regular")).alias("headway_regular_share"),
        one(ttv, F.avg("ttv_ok")).alias("ttv_ok_share"),
        operation_total.select("overall_avl_confirmed_rate").scalar().alias("avl_floor"),
    )


def disruptions_by_reason(latest: DataFrame, limit: int = 10) -> DataFrame:
    return (
        latest.filter(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "reason")
        .limit(limit)
    )


def disruption_kpis(fact_disruption: DataFrame, bridge: DataFrame) -> DataFrame:
    links = bridge.agg(F.count(F.lit(1))).scalar()
    return fact_disruption.agg(
        F.count(F.lit(1)).alias("situations"),
        F.coalesce(F.sum("wy_specific"), F.lit(0)).alias("region_specific"),
        F.avg("planned").alias("planned_share"),
    ).select("*", links.alias("stop_links"))


def disruption_list(fact_disruption: DataFrame) -> DataFrame:
    return fact_disruption.select(
        "situation_id",
        "reason",
        "planned",
        "summary",
        "validity_start",
        "validity_end",
        "n_affected_stops",
    ).orderBy(F.desc("n_affected_stops"), "situation_id")
