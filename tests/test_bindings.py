"""Bound tables keep every row of their source."""

from __future__ import annotations

from conftest import SMALL
from pyspark.sql import functions as F

from timepoint.plans.binding import AREA_SOUTH, AREA_WEST, AREA_WIDTH, Tables


def test_no_rows_are_cut(tables):
    n = {name: tables.raw(name).count() for name in ("events", "customer", "lineitem", "labels")}
    assert tables.situation_documents.count() == n["events"]
    assert tables.areas_raw.count() == tables.deprivation.count() == n["customer"]
    assert tables.pings_all.count() == n["lineitem"]
    assert tables.predictions.count() == 3 * n["labels"]
    hours = tables.raw("events").select(F.date_trunc("hour", "ts")).distinct().count()
    assert tables.weather.count() == hours > 24 * 20


def test_mismatches_are_kept_rows(tables):
    codes = tables.deprivation.select("lsoa_code")
    assert 0 < tables.areas.join(codes, "lsoa_code", "left_anti").count()
    assert 0 < codes.join(tables.areas, "lsoa_code", "left_anti").count()


def test_areas_of_further_millions_do_not_overlap(spark):
    ids = [k + m * 1_000_000 for k in (7, 8, 123_456) for m in (0, 1, 2, 5, 1500)]
    placed = spark.createDataFrame([(i,) for i in ids], "area bigint").selectExpr(
        f"{AREA_WEST.format(area='area')} as west",
        f"{AREA_SOUTH.format(area='area')} as south",
        f"{AREA_WIDTH.format(area='area')} as width",
    )
    rows = sorted((r.south, r.west, r.width) for r in placed.collect())
    for (south, west, width), (next_south, next_west, _) in zip(rows, rows[1:], strict=False):
        assert south != next_south or west + width <= next_west + 1e-12
        assert width > 0


def test_tables_of_another_folder_are_apart(spark):
    assert Tables(spark, SMALL).sf_dir == SMALL
