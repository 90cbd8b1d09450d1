"""Registered queries against their SQL on the smallest tables.

A representative part runs by default; TIMEPOINT_ALL_CHECKS=1 runs every query.
"""

from __future__ import annotations

import os

import oracle
import pytest
from conftest import SMALL

from timepoint.plans import CHECKS, QUERIES

DEFAULT = (
    "worst_routes", "nearest_ping", "headway_observed", "operation_floor_by_operator",
    "stop_reliability", "point_in_polygon", "route_deprivation", "compliance_by_decile",
    "permutation_pvalue", "frequency_confound", "active_disruptions", "feature_table",
    "dedup_pings", "parse_quality_by_day", "decode_position_snapshots", "decode_situations",
    "weather_hourly", "fk_violations", "record_counts", "model_comparison", "roc_points",
    "best_threshold", "calibration_curve", "histogram", "box_stats_by_band", "band_day_pivot",
    "stream_dedup_pings", "stream_quality", "stream_situations", "write_partitioned",
)
CHOSEN = sorted(CHECKS) if os.environ.get("TIMEPOINT_ALL_CHECKS") else DEFAULT


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SMALL):
        pytest.skip("driver tables are not here")
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    got = oracle.spark_table(QUERIES[name](spark, SMALL))
    assert oracle.difference(got, oracle.sql_table(con, CHECKS[name])) is None
    assert got[1], "no rows to compare"


@pytest.mark.parametrize(
    ("name", "table", "column"),
    [
        ("histogram", "delays", "delay_min"),
        ("overview_kpis", "delays", "delay_min"),
        ("ttv_headway_summary", "delays", "inferred_sec"),
        ("fk_violations", "situations_latest", "situation_id"),
    ],
)
def test_costly_tables_are_computed_once(spark, tables, monkeypatch, name, table, column):
    from pyspark.sql import functions as F

    from timepoint.plans.binding import Tables

    seen = spark.sparkContext.accumulator(0)

    def counted(value):
        seen.add(1)
        return value

    rows = getattr(tables, table).cache()
    n, kind = rows.count(), rows.schema[column].dataType
    passed = F.udf(counted, kind).asNondeterministic()
    monkeypatch.setattr(Tables, table, rows.withColumn(column, passed(column)))
    QUERIES[name](spark, tables.sf_dir).collect()
    assert n > 0 and seen.value == n
    rows.unpersist()
