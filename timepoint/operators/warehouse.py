"""Star-schema dimensions, facts, key checks and last-wins upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.functions.columns import discover_columns
from timepoint.operators.dedup import keep_first, keep_latest
from timepoint.operators.disruptions import explode_refs

# Declared primary keys and (child, column, parent, column) references.
PRIMARY_KEYS = {
    "dim_lsoa": ("lsoa_code",),
    "dim_route": ("route_id",),
    "dim_stop": ("stop_id",),
    "fact_trip_delay": ("trip_id", "service_date"),
    "fact_route_band_day": ("route_id", "service_date", "time_band"),
    "fact_disruption": ("situation_id",),
    "disruption_stop": ("situation_id", "stop_id"),
}
FOREIGN_KEYS = (
    ("dim_stop", "lsoa_code", "dim_lsoa"),
    ("fact_trip_delay", "route_id", "dim_route"),
    ("fact_route_band_day", "route_id", "dim_route"),
    ("disruption_stop", "situation_id", "fact_disruption"),
    ("disruption_stop", "stop_id", "dim_stop"),
)


def dim_lsoa(stop_areas: DataFrame) -> DataFrame:
    known = stop_areas.filter(F.col("lsoa_code").isNotNull())
    return keep_first(known.select("lsoa_code", "imd_decile", "imd_score"), ["lsoa_code"])


def dim_stop(stops: DataFrame, stop_areas: DataFrame) -> DataFrame:
    named = keep_first(stops, ["stop_id"]).withColumnsRenamed(
        {"stop_name": "name", "stop_lat": "lat", "stop_lon": "lon"}
    )
    return named.join(stop_areas.select("stop_id", "lsoa_code"), "stop_id", "left")


def dim_route(routes: DataFrame, route_areas: DataFrame) -> DataFrame:
    return (
        keep_first(routes, ["route_id"])
        .withColumnRenamed("agency_id", "operator")
        .join(route_areas.select("route_id", "route_imd_decile"), "route_id", "left")
        .select(
            "route_id",
            "operator",
            "route_short_name",
            F.col("route_imd_decile").cast("double").alias("route_imd_decile"),
        )
    )


def fact_trip(trips: DataFrame) -> DataFrame:
    """Trip facts with the first on-time flag found as ``on_time``."""
    flags = discover_columns(trips.columns, prefix="on_time_")
    on_time = F.col(flags[0]) if flags else F.lit(None).cast("int")
    return trips.select(
        "trip_id",
        "route_id",
        "service_date",
        "time_band",
        "day_of_week",
        "stops_observed",
        "median_delay",
        on_time.alias("on_time"),
    )


def fact_route_band_day(facts: DataFrame) -> DataFrame:
    return facts.select(
        "route_id",
        "service_date",
        "time_band",
        "day_of_week",
        "n_trips",
        "pct_on_time",
        "sd_trip_delay",
        "compliant",
    )


def fact_disruption(latest: DataFrame) -> DataFrame:
    return latest.select(
        "situation_id",
        "reason",
        F.col("planned").cast("int").alias("planned"),
        "progress",
        "summary",
        "validity_start",
        "validity_end",
        "n_affected_stops",
        F.col("wy_specific").cast("int").alias("wy_specific"),
    )


def disruption_refs(latest: DataFrame) -> DataFrame:
    return explode_refs(latest.select("situation_id", "wy_stop_refs"))


def known_stops(refs: DataFrame, stops: DataFrame) -> DataFrame:
    return refs.join(stops.select("stop_id"), "stop_id", "left_semi")


def bridge_disruption_stop(latest: DataFrame, stops: DataFrame) -> DataFrame:
    """Distinct (situation, known stop) pairs."""
    return known_stops(disruption_refs(latest), stops).distinct().select("situation_id", "stop_id")


def bridge_match_counts(latest: DataFrame, stops: DataFrame) -> DataFrame:
    """One row: stop references listed, and distinct ones that name a known stop."""
    listed = disruption_refs(latest).agg(F.count(F.lit(1)).alias("refs"))
    matched = bridge_disruption_stop(latest, stops).agg(F.count(F.lit(1)).alias("matched"))
    return listed.select("refs", matched.scalar().alias("matched"))


def upsert_last_wins(
    current: DataFrame, arriving: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Current rows replaced by arriving rows of the same key; the latest arrival wins."""
    stacked = current.withColumn("_load", F.lit(0)).unionByName(
        arriving.withColumn("_load", F.lit(1)), allowMissingColumns=True
    )
    return keep_latest(stacked, keys, ["_load", *order]).drop("_load")


def pk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: keys that occur more than once, and the rows beyond the first."""
    parts = []
    for name, keys in PRIMARY_KEYS.items():
        if name in tables:
            repeats = tables[name].groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            parts.append(
                repeats.agg(
                    F.lit(name).alias("table_name"),
                    F.count(F.lit(1)).alias("repeated_keys"),
                    F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
                )
            )
    return _stack(parts)


def fk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per declared reference: rows whose non-NULL value is missing from the parent."""
    parts = []
    for child, column, parent in FOREIGN_KEYS:
        if child in tables and parent in tables:
            # count per value first: a hot value is one row in the anti join
            values = (
                tables[child]
                .filter(F.col(column).isNotNull())
                .groupBy(column)
                .agg(F.count(F.lit(1)).alias("n"))
            )
            orphans = values.join(tables[parent].select(column), column, "left_anti")
            parts.append(
                orphans.agg(
                    F.lit(child).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.coalesce(F.sum("n"), F.lit(0)).alias("violations"),
                )
            )
    return _stack(parts)


def _stack(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("no table with a declared key was given")
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked
