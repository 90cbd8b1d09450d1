"""Hourly weather documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Field names of the weather service's hourly object.
HOURLY_FIELDS = ("time", "precipitation", "temperature_2m", "wind_speed_10m")
DOCUMENT = (
    "hourly struct<time: array<string>, precipitation: array<double>, "
    "temperature_2m: array<double>, wind_speed_10m: array<double>>"
)


def weather_hourly(documents: DataFrame, column: str = "document") -> DataFrame:
    """One row per hour out of JSON documents of parallel arrays."""
    parsed = documents.select(F.from_json(column, DOCUMENT).alias("doc"))
    rows = parsed.select(
        F.inline(F.arrays_zip(*(F.col(f"doc.hourly.{f}") for f in HOURLY_FIELDS)))
    )
    at = F.to_timestamp_ntz("time", F.lit("yyyy-MM-dd'T'HH:mm"))
    return rows.select(
        at.alias("ts_local"),
        F.col("precipitation").alias("precip_mm"),
        F.col("temperature_2m").alias("temp_c"),
        F.col("wind_speed_10m").alias("wind_kph"),
        F.to_date(at).alias("service_date"),
        F.hour(at).alias("hour"),
    )
