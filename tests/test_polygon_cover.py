"""Cells of areas: the same answers as all edges, and rows that grow with their own cell only."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from timepoint.operators import spatial

AREAS = "lsoa_code string, rings array<array<struct<x: double, y: double>>>"


def star(rng, x, y, size, corners, whole=False):
    """A closed ring around a point, whose corners lie on a coarse grid if ``whole``."""
    ring = []
    for k in range(corners):
        angle, reach = 2 * math.pi * k / corners, size * rng.uniform(0.3, 1.0)
        at = (x + reach * math.cos(angle), y + reach * math.sin(angle))
        ring.append(tuple(round(v, 1) for v in at) if whole else at)
    return [*ring, ring[0]]


def some_areas():
    rng = random.Random(8)
    areas = [(f"small{k}", [star(rng, rng.uniform(-3, 3), rng.uniform(-3, 3), 0.2, 7)]) for k in range(150)]
    areas += [(f"grid{k}", [star(rng, rng.uniform(-3, 3), rng.uniform(-3, 3), 0.6, 9, True)]) for k in range(20)]
    # a continent with a lake and an island, one with very many edges, a thin one, flat ones
    areas.append(("huge", [star(rng, 0, 0, 40, 11), star(rng, 0.5, 0.5, 1.0, 30), star(rng, 0.5, 0.5, 0.2, 5)]))
    areas.append(("coast", [star(rng, 1, 1, 8, 3000)]))
    areas.append(("thin", [[(-50.0, 0.1), (50.0, 0.11), (50.0, 0.12), (-50.0, 0.105), (-50.0, 0.1)]]))
    areas.append(("box", [[(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0)]]))
    areas.append(("line", [[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]))
    side = [k / 10 for k in range(100)]
    field = [(x, 0.0) for x in side] + [(10.0, y) for y in side] + [(10 - x, 10.0) for x in side]
    areas.append(("field", [[(x - 5, y - 5) for x, y in [*field, *((0.0, 10 - y) for y in side), (0.0, 0.0)]]]))
    areas += [("empty", []), ("none", None), ("point", [[(0.5, 0.5)]])]
    return areas


@pytest.fixture(scope="module")
def placed(spark):
    rng = random.Random(9)
    areas = some_areas()
    corners = [p for _, rings in areas for ring in rings or [] for p in ring[:4]]
    points = [(rng.uniform(-4, 4), rng.uniform(-4, 4)) for _ in range(1500)]
    points += [(round(x, 1), round(y, 1)) for x, y in points[:500]] + rng.sample(corners, 300)
    points += [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(300)] + [(0.0, 0.108), (30.0, 0.11)]
    stops = [(f"s{k}", y, x) for k, (x, y) in enumerate(points)] + [("nowhere", None, None)]
    return (
        spark.createDataFrame(stops, "stop_id string, stop_lat double, stop_lon double"),
        spark.createDataFrame(areas, AREAS),
    )


def test_cover_gives_what_all_edges_give(placed):
    stops, areas = placed
    edges = areas.filter("rings is not null").select("lsoa_code", spatial.polygon_edges(F.col("rings")).alias("edges"))
    inside = spatial.strictly_inside(F.col("stop_lon"), F.col("stop_lat"), F.col("edges"))
    hits = stops.join(F.broadcast(edges), inside)  # only a test compares all with all
    expected = sorted((r.stop_id, r.lsoa_code) for r in hits.collect())
    got = spatial.point_in_polygon(stops, areas).collect()
    assert sorted((r.stop_id, r.lsoa_code) for r in got if r.lsoa_code) == expected
    assert {r.stop_id for r in got} == {r.stop_id for r in stops.collect()}
    assert len(expected) > 1500 and {"huge", "coast", "thin", "box"} <= {c for _, c in expected}


def test_rows_grow_with_the_edges_of_their_cell(placed):
    _, areas = placed
    cover = spatial.polygon_cover(areas)
    by_area = {
        r.lsoa_code: r
        for r in cover.groupBy("lsoa_code")
        .agg(F.count(F.lit(1)).alias("cells"), F.max(F.size("edges")).alias("most"),
             F.sum(F.size("edges")).alias("edges"), F.max("level").alias("level"))
        .collect()
    }
    assert by_area["small0"].level < by_area["box"].level < by_area["huge"].level
    assert by_area["small0"].cells <= 4 * (spatial.FEW_CELLS + 7)
    # the continent has about as many cells as edges, though it is very large ...
    assert by_area["huge"].cells <= 4 * (spatial.FEW_CELLS + 46)
    # ... and of the 3,000 edges of the jagged coast, which are long, no row holds many
    assert by_area["coast"].most < 300
    inner = cover.filter("lsoa_code = 'field' and size(edges) = 0")
    assert inner.count() > 20 and inner.filter("not flag").count() == 0


def test_no_areas_and_no_stops(spark, placed):
    stops, areas = placed
    assert spatial.point_in_polygon(stops, areas.filter("false")).filter("lsoa_code is not null").count() == 0
    assert spatial.point_in_polygon(stops.filter("false"), areas).count() == 0
