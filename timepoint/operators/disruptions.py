"""Disruptions joined to stops, routes and dates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.functions.columns import split_refs
from timepoint.functions.timeofday import iso_date_prefix

OPEN_END = dt.date(2099, 1, 1)  # fixed value: end of a notice that names none


def stop_route_bridge(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Distinct (stop, route) pairs through trips."""
    return (
        stop_times.select("trip_id", "stop_id")
        .join(trips.select("trip_id", "route_id"), "trip_id")
        .select("stop_id", "route_id")
        .distinct()
    )


def named_stops_with_start(situations: DataFrame) -> DataFrame:
    """Situations that name region stops and have a start."""
    return situations.filter(F.col("wy_specific") & F.col("validity_start").isNotNull())


def explode_refs(situations: DataFrame, refs: str = "wy_stop_refs") -> DataFrame:
    """One row per (situation, stop reference)."""
    return situations.withColumn("stop_id", F.explode(split_refs(F.col(refs)))).drop(refs)


def validity_range_join(notices: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """Notices x study dates inside their validity (inclusive).

    Each notice lists its own dates, clipped to the study window first, so there is no
    range join: work is one row per notice and active day.
    """
    listed = F.array(*(F.lit(d) for d in sorted(dates)))
    active = F.filter(listed, lambda d: d.between(F.col("v_start"), F.col("v_end")))
    return notices.withColumn("service_date", F.explode(active))


def notice_dates(situations: DataFrame) -> DataFrame:
    return situations.withColumns(
        {
            "v_start": iso_date_prefix(F.col("validity_start")),
            "v_end": F.coalesce(iso_date_prefix(F.col("validity_end")), F.lit(OPEN_END)),
        }
    )


def active_disruptions(
    latest: DataFrame, stop_routes: DataFrame, dates: Sequence[dt.date]
) -> DataFrame:
    """Distinct situations active per (route, date); ``latest`` has one row per situation.

    Notices that no study date falls into go first, then only stops that some notice names are
    asked for their routes. Situations meet routes as distinct (situation, route) pairs, so
    dates multiply the small side only.
    """
    first, last = F.lit(min(dates)), F.lit(max(dates))
    notices = (
        notice_dates(named_stops_with_start(latest))
        .filter((F.col("v_start") <= last) & (F.col("v_end") >= first))
        .select("situation_id", "wy_stop_refs", "v_start", "v_end")
    )
    refs = explode_refs(notices).distinct()
    on_routes = (
        refs.join(stop_routes, "stop_id")
        .select("situation_id", "route_id", "v_start", "v_end")
        .distinct()
    )
    return (
        validity_range_join(on_routes, dates)
        .groupBy("route_id", "service_date")
        .agg(F.countDistinct("situation_id").alias("n_active_disruptions"))
    )
