"""Spatial operators on polygon rings, without a geometry library.

A polygon is ``rings: array<array<struct<x, y>>>``. Containment is even-odd over all rings
together, so holes and multi-part areas need no special case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timepoint.settings import Box


def _extreme(rings: Column, axis: str, pick) -> Column:
    return pick(F.transform(rings, lambda ring: pick(F.transform(ring, lambda p: p[axis]))))


def with_extent(areas: DataFrame) -> DataFrame:
    """Add the bounding box (west, east, south, north) of every polygon."""
    rings = F.col("rings")
    return areas.withColumns(
        {
            "west": _extreme(rings, "x", F.array_min),
            "east": _extreme(rings, "x", F.array_max),
            "south": _extreme(rings, "y", F.array_min),
            "north": _extreme(rings, "y", F.array_max),
        }
    )


def polygons_in_bbox(areas: DataFrame, box: Box) -> DataFrame:
    """Polygons whose bounding box meets the region box; coordinates must be WGS84."""
    overlap = (
        (F.col("west") <= box.max_lon)
        & (F.col("east") >= box.min_lon)
        & (F.col("south") <= box.max_lat)
        & (F.col("north") >= box.min_lat)
    )
    return with_extent(areas).filter(overlap).select(*areas.columns)


def polygon_edges(rings: Column) -> Column:
    """All ring edges as ``struct(ax, ay, bx, by)``; a ring of fewer than two points has none."""
    return F.flatten(
        F.transform(
            F.filter(rings, lambda ring: F.size(ring) > 1),
            lambda ring: F.transform(
                F.sequence(F.lit(2), F.size(ring)),
                lambda i: F.named_struct(
                    F.lit("ax"),
                    F.element_at(ring, i - 1)["x"],
                    F.lit("ay"),
                    F.element_at(ring, i - 1)["y"],
                    F.lit("bx"),
                    F.element_at(ring, i)["x"],
                    F.lit("by"),
                    F.element_at(ring, i)["y"],
                ),
            ),
        )
    )


def strictly_inside(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd ray cast; a point on any edge is not inside."""

    odd = F.size(F.filter(edges, lambda e: _crosses(e, x, y))) % 2 == 1
    return odd & ~F.exists(edges, lambda e: _touches(e, x, y))


#: Cells that an area may cover beyond one per edge, and how much wider a level's cells are.
FEW_CELLS, WIDER = 4, 4
#: Degrees by which cells overlap their neighbours, far above any rounding of coordinates.
MARGIN = 1e-9
_EDGE = ("ax", "ay", "bx", "by")


def _cell(degrees: Column, width: Column) -> Column:
    return F.floor(degrees / width)


def _cells(low: Column, high: Column, width: Column) -> Column:
    return F.sequence(_cell(low - MARGIN, width), _cell(high + MARGIN, width))


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether the ray from (x, y) to the east meets the edge."""
    straddles = (e["ay"] > y) != (e["by"] > y)
    at = (e["bx"] - e["ax"]) * ((y - e["ay"]) / (e["by"] - e["ay"])) + e["ax"]
    return F.when(straddles, x < at).otherwise(False)


def _touches(e: Column, x: Column, y: Column) -> Column:
    turn = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
    return (
        (turn == 0.0)
        & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
        & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
    )


def _sized(areas: DataFrame, key: str) -> DataFrame:
    """Every area's edges, extent and the level it is cut at."""
    across, up = F.col("east") - F.col("west"), F.col("north") - F.col("south")
    allowed = F.size("edges") + FEW_CELLS
    # at this width there are as many cells as allowed, along both axes and along one of them
    wanted = F.greatest(F.sqrt(across * up / allowed), F.greatest(across, up) / allowed, F.lit(1e-6))
    level = F.ceil(F.log(wanted) / F.log(F.lit(float(WIDER)))).cast("int")
    return (
        with_extent(areas)
        .withColumn("edges", polygon_edges(F.col("rings")))
        .filter(F.size("edges") > 0)
        .withColumn("level", level)
        .withColumn("width", F.pow(F.lit(float(WIDER)), F.col("level")))
        .select(key, "level", "width", "west", "east", "south", "north", "edges")
    )


def polygon_cover(areas: DataFrame, key: str = "lsoa_code") -> DataFrame:
    """Grid cells of every area, each with the edges near it and what lies beyond them.

    A row is (key, level, width, cell_x, cell_y, line, flag, edges). ``edges`` are those whose
    box meets the cell, so a row grows with the boundary in its cell and with nothing else; a
    cell wholly inside has none, one wholly outside has no row. ``flag`` says how the rest of
    the boundary counts for a ray to the east: the edges that cross the cell's east side,
    ``line``, wholly above it, modulo two. Those that cross it at the cell's height are at hand,
    and of what lies east of it only the ends count (see :func:`inside_cell`).

    Cells of a level are ``WIDER`` times as wide as those of the one below. An area takes the
    finest level at which it covers about as many cells as it has edges and ``FEW_CELLS``, so
    the cover is as large as the areas are, also when one of them is a continent. Rings are
    closed.
    """
    sized = _sized(areas, key)
    low_x, high_x = F.least("ax", "bx"), F.greatest("ax", "bx")
    low_y, high_y = F.least("ay", "by"), F.greatest("ay", "by")
    columns = (
        sized.select(key, "level", "width", F.inline("edges"))
        .withColumn("rows", _cells(low_y, high_y, F.col("width")))
        .withColumn("cell_x", F.explode(_cells(low_x, high_x, F.col("width"))))
        .withColumn("line", (F.col("cell_x") + 1) * F.col("width") + MARGIN)
    )
    place = [key, "level", "width", "cell_x", "line"]
    passes = (F.col("ax") > F.col("line")) != (F.col("bx") > F.col("line"))
    listed = columns.select(
        *place,
        F.posexplode("rows").alias("row", "cell_y"),
        F.struct(*_EDGE).alias("edge"),
        passes.alias("passes"),
    ).select(*place, "cell_y", "edge", (F.col("passes") & (F.col("row") == 0)).cast("int").alias("starts"))
    grid = sized.select(
        key, "level", "width", "south", "north",
        F.explode(_cells(F.col("west"), F.col("east"), F.col("width"))).alias("cell_x"),
    ).select(
        key,
        "level",
        "width",
        "cell_x",
        ((F.col("cell_x") + 1) * F.col("width") + MARGIN).alias("line"),
        F.explode(_cells(F.col("south"), F.col("north"), F.col("width"))).alias("cell_y"),
        F.lit(None).cast("struct<ax:double,ay:double,bx:double,by:double>").alias("edge"),
        F.lit(0).alias("starts"),
    )
    # one exchange by column of cells serves the cells and the counts down the column
    cells = (
        listed.unionByName(grid)
        .repartition(key, "cell_x")
        .groupBy(*place, "cell_y")
        .agg(F.collect_list("edge").alias("edges"), F.sum("starts").alias("starts"))
    )
    above = (
        Window.partitionBy(key, "cell_x")
        .orderBy(F.col("cell_y").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    flag = F.coalesce(F.sum("starts").over(above), F.lit(0)) % 2 == 1
    return (
        cells.withColumn("flag", flag)
        .filter(F.col("flag") | (F.size("edges") > 0))
        .select(*place, "cell_y", "flag", "edges")
    )


def inside_cell(x: Column, y: Column) -> Column:
    """Whether a point of a cell of :func:`polygon_cover` is strictly inside the area.

    The same as :func:`strictly_inside` on all edges: what crosses the ray beyond ``line`` is
    the edges wholly east of it, and of their ends only those are left over that an edge
    crossing the line shares; one such edge counts when its eastern end lies above the point.
    """
    line = F.col("line")

    def counts(e: Column) -> Column:
        end = F.when(e["ax"] > line, e["ay"]).otherwise(e["by"])
        passes = ((e["ax"] > line) != (e["bx"] > line)) & (end > y)
        return _crosses(e, x, y) != passes

    odd = F.size(F.filter("edges", counts)) % 2 == 1
    return (F.col("flag") != odd) & ~F.exists("edges", lambda e: _touches(e, x, y))


def point_in_polygon(stops: DataFrame, areas: DataFrame) -> DataFrame:
    """Left join of stops to every area that strictly contains them.

    Stops and the cells of :func:`polygon_cover` meet in an equi-join on (level, cell); a stop
    has one cell on each level that an area uses. Only the keys of hits are joined back.
    """
    # as many levels as the logarithm of how much larger than typical an area can be
    used = F.collect_set(F.struct("level", "width"))
    levels = _sized(areas, "lsoa_code").agg(used).scalar()
    x, y = F.col("stop_lon"), F.col("stop_lat")
    placed = stops.select("stop_id", "stop_lat", "stop_lon", F.inline(levels)).select(
        "stop_id",
        "stop_lat",
        "stop_lon",
        "level",
        _cell(x, F.col("width")).alias("cell_x"),
        _cell(y, F.col("width")).alias("cell_y"),
    )
    hits = (
        placed.join(polygon_cover(areas).drop("width"), ["level", "cell_x", "cell_y"])
        .filter(inside_cell(x, y))
        .select("stop_id", "lsoa_code")
    )
    return stops.select("stop_id").join(hits, "stop_id", "left")
