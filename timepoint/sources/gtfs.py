"""Timetable files: scan, region filter and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timepoint.functions.geo import in_bbox
from timepoint.functions.timeofday import date_of_calendar_int
from timepoint.operators.dedup import keep_first
from timepoint.settings import DAY_NAMES, Box
from timepoint.sources.storage import existing_paths

WEEKDAYS = tuple(d.lower() for d in DAY_NAMES)

# The columns read from each file (identifiers are text, whatever they look like).
GTFS_COLUMNS = {
    "stops": "stop_id string, stop_name string, stop_lat double, stop_lon double",
    "routes": "route_id string, agency_id string, route_short_name string",
    "trips": "trip_id string, route_id string, service_id string",
    "stop_times": "trip_id string, stop_id string, stop_sequence int, arrival_time string",
    "calendar": "service_id string, "
    + ", ".join(f"{d} int" for d in WEEKDAYS)
    + ", start_date int, end_date int",
}


def read_gtfs_table(
    spark: SparkSession, directories: Sequence[str], name: str
) -> DataFrame | None:
    """One table out of several timetable directories; None when no file exists.

    Each file is read through its own header, so files may order their columns differently
    or lack optional ones. Values are then cast to the declared types, with NULL for text
    that does not parse; no inference pass over the data.
    """
    declared = T.StructType.fromDDL(GTFS_COLUMNS[name])
    found = existing_paths(spark, [f"{d.rstrip('/')}/{name}.txt" for d in directories])
    parts = []
    for path in found:
        text = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
        parts.append(
            text.select(
                *(
                    (
                        F.col(f"`{f.name}`").try_cast(f.dataType)
                        if f.name in text.columns
                        else F.lit(None).cast(f.dataType)
                    ).alias(f.name)
                    for f in declared
                )
            )
        )
    if not parts:
        return None
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def stops_in_region(stops: DataFrame, box: Box) -> DataFrame:
    """One row per stop, inside the region box (inclusive)."""
    return keep_first(stops, ["stop_id"]).filter(
        in_bbox(F.col("stop_lat"), F.col("stop_lon"), box)
    )


def routes_dedup(routes: DataFrame) -> DataFrame:
    return keep_first(routes, ["route_id"])


def stop_times_in_region(
    stop_times: DataFrame, stops: DataFrame, distinct: bool = True
) -> DataFrame:
    """Stop times at region stops; rows repeated by overlapping feeds are removed."""
    kept = stop_times.select("trip_id", "stop_id", "stop_sequence", "arrival_time").join(
        stops.select("stop_id"), "stop_id", "left_semi"
    )
    return kept.distinct() if distinct else kept


def trips_dedup(trips: DataFrame) -> DataFrame:
    return keep_first(trips, ["trip_id"])


def trips_touching_region(trips: DataFrame, region_stop_times: DataFrame) -> DataFrame:
    """Trips with at least one stop in the region, one row each."""
    touched = trips.join(region_stop_times.select("trip_id"), "trip_id", "left_semi")
    return trips_dedup(touched)


def calendar_validity(calendar: DataFrame) -> DataFrame:
    """Weekday flags with the validity range as dates."""
    return calendar.select(
        "service_id",
        *WEEKDAYS,
        date_of_calendar_int(F.col("start_date")).alias("valid_from"),
        date_of_calendar_int(F.col("end_date")).alias("valid_to"),
    )
