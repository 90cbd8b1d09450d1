"""Geographic column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from timepoint.settings import Box

EARTH_RADIUS_M = 6_371_000.0


def _half_angle_sin_squared(delta_deg: Column) -> Column:
    half = F.sin(F.radians(delta_deg) / F.lit(2.0))
    return half * half


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between two WGS84 points."""
    chord = _half_angle_sin_squared(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * _half_angle_sin_squared(lon2 - lon1)
    return F.asin(F.sqrt(chord)) * F.lit(2.0 * EARTH_RADIUS_M)


def in_bbox(lat: Column, lon: Column, box: Box) -> Column:
    """Inclusive test; NULL coordinates give NULL, so a filter drops them."""
    return lat.between(box.min_lat, box.max_lat) & lon.between(box.min_lon, box.max_lon)


class Grid:
    """Square degree cells used to turn "within r metres" into an equi-join.

    ``cells_around`` lists every cell a circle can touch, so joining it to ``cell_of`` on
    the cell can never lose a pair; the caller applies the exact distance afterwards.
    Longitude cells wrap at the antimeridian because their count divides 360 degrees.
    """

    def __init__(self, radius_m: float, cells_per_radius: float = 8.0) -> None:
        self.radius_m = radius_m
        wanted = max(math.degrees(radius_m / EARTH_RADIUS_M) * cells_per_radius, 1e-9)
        self.around_globe = max(int(360.0 / wanted), 1)
        self.cell_deg = 360.0 / self.around_globe

    def _index(self, degrees: Column) -> Column:
        return F.floor(degrees / F.lit(self.cell_deg))

    def cell_of(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """(column index, row index) of the cell that holds a point."""
        return F.pmod(self._index(lon), F.lit(self.around_globe)), self._index(lat)

    def cells_around(self, lat: Column, lon: Column) -> Column:
        """Array of ``struct(cell_x, cell_y)`` touched by the circle round a point."""
        slack = 1.0001
        angle = self.radius_m / EARTH_RADIUS_M
        reach_lat = F.lit(math.degrees(angle) * slack)
        ratio = F.lit(math.sin(angle)) / F.abs(F.cos(F.radians(lat)))
        reach_lon = F.when(
            ratio < 1.0, F.degrees(F.asin(ratio)) * slack
        ).otherwise(F.lit(180.0))
        rows = F.sequence(self._index(lat - reach_lat), self._index(lat + reach_lat))
        cols = F.sequence(self._index(lon - reach_lon), self._index(lon + reach_lon))
        wrapped = F.array_distinct(
            F.transform(cols, lambda c: F.pmod(c, F.lit(self.around_globe)))
        )
        return F.flatten(
            F.transform(
                rows,
                lambda r: F.transform(
                    wrapped, lambda c: F.named_struct(F.lit("cell_x"), c, F.lit("cell_y"), r)
                ),
            )
        )
