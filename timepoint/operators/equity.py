"""Deprivation attached to stops and routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def area_attributes(stop_areas: DataFrame, deprivation: DataFrame) -> DataFrame:
    """Stops with their area's decile and score; unmatched stops keep NULLs."""
    return stop_areas.join(deprivation, "lsoa_code", "left").select(
        "stop_id", "lsoa_code", "imd_decile", "imd_score"
    )


def route_deprivation(stop_routes: DataFrame, stop_areas: DataFrame) -> DataFrame:
    """Lower-median and minimum decile over the distinct stops of each route."""
    served = stop_routes.join(
        stop_areas.select("stop_id", "imd_decile"), "stop_id"
    ).distinct()
    return served.groupBy("route_id").agg(
        F.expr("percentile_disc(0.5) within group (order by imd_decile)")
        .cast("int")
        .alias("route_imd_decile"),
        F.min("imd_decile").alias("route_min_imd_decile"),
        F.countDistinct("stop_id").alias("n_stops_with_imd"),
    )


def stops_per_route(stop_routes: DataFrame) -> DataFrame:
    return stop_routes.groupBy("route_id").agg(F.countDistinct("stop_id").alias("n_stops"))
