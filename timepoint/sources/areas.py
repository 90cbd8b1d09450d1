"""Area polygons (GeoJSON) and deprivation scores (CSV)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timepoint.functions.columns import discover_columns

_GEOMETRY = "type: string, coordinates: string"


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Polygons of FeatureCollection files in WGS84: (lsoa_code, rings).

    The code is the first property whose name mentions an LSOA code. Polygons keep all
    their rings; the parts of a MultiPolygon are read as one area.
    """
    document = (
        "features array<struct<properties: map<string, string>, "
        f"geometry: struct<{_GEOMETRY}>>>"
    )
    features = (
        spark.read.schema(document)
        .option("multiLine", True)
        .json(path)
        .select(F.explode("features").alias("feature"))
    )
    geometry = F.col("feature.geometry")
    coordinates = geometry["coordinates"]
    single = F.from_json(coordinates, "array<array<array<double>>>")
    several = F.flatten(F.from_json(coordinates, "array<array<array<array<double>>>>"))
    points = F.when(geometry["type"] == "MultiPolygon", several).otherwise(single)
    rings = F.transform(
        points,
        lambda ring: F.transform(
            ring, lambda p: F.named_struct(F.lit("x"), p[0], F.lit("y"), p[1])
        ),
    )
    return features.select(
        area_code(F.col("feature.properties")).alias("lsoa_code"), rings.alias("rings")
    )


def area_code(properties: Column) -> Column:
    """Value of the property that names the area: "lsoa..cd" first, else any "lsoa"."""
    names = F.map_keys(properties)

    def first(test) -> Column:
        return F.get(F.filter(names, test), F.lit(0))

    exact = first(lambda k: F.lower(k).contains("lsoa") & F.lower(k).contains("cd"))
    loose = first(lambda k: F.lower(k).contains("lsoa"))
    return F.element_at(properties, F.coalesce(exact, loose))


def deprivation_columns(names: Sequence[str]) -> tuple[str, str | None, str | None]:
    """(code, decile, score) columns, preferring the overall index over its sub-domains."""
    code = next(iter(discover_columns(names, "lsoa", "code")), names[0])

    def pick(kind: str) -> str | None:
        overall = discover_columns(names, kind, "multiple deprivation")
        return next(iter(overall or discover_columns(names, kind)), None)

    return code, pick("decile"), pick("score")


def deprivation_table(table: DataFrame) -> DataFrame:
    """(lsoa_code, imd_decile, imd_score) out of a table with any column names."""
    code, decile, score = deprivation_columns(table.columns)

    def number(name: str | None, kind: str) -> Column:
        return F.lit(None).cast(kind) if name is None else F.col(f"`{name}`").try_cast(kind)

    return table.select(
        F.col(f"`{code}`").cast("string").alias("lsoa_code"),
        number(decile, "int").alias("imd_decile"),
        number(score, "double").alias("imd_score"),
    )


def read_imd(spark: SparkSession, path: str) -> DataFrame:
    """Deprivation CSV with its columns found by name."""
    return deprivation_table(spark.read.option("header", True).csv(path))
