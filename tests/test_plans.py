"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL

from timepoint.plans import CHECKS, QUERIES

CHAINS = (
    "worst_routes", "headway_observed", "operation_floor_by_operator", "point_in_polygon",
    "active_disruptions", "dedup_pings", "parse_quality_by_day", "sensitivity_windows",
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHAINS)
def test_no_nested_loops_or_python(spark, tables, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


def test_no_window_over_all_rows(spark, tables):
    for name in CHAINS:
        lines = plan(QUERIES[name](spark, SMALL)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert not any("Window " in above for above in lines[max(i - 3, 0) : i]), name


def test_group_limit_runs_before_the_shuffle(spark, tables):
    text = plan(QUERIES["nearest_ping"](spark, SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_match_scan_reads_only_needed_columns(spark, tables):
    text = plan(QUERIES["nearest_ping"](spark, SMALL))
    for column in ("l_extendedprice", "l_shipdate", "l_returnflag"):
        assert column not in text


def test_notices_read_every_event(spark, tables):
    text = plan(QUERIES["decode_situations"](spark, SMALL))
    assert "EqualTo(event_type" not in text and "LessThan(ts" not in text


def test_registry_is_consistent():
    assert set(CHECKS) <= set(QUERIES)
    assert len(QUERIES) - len(CHECKS) < 12


def test_notices_are_decoded_once_behind_their_exchange(spark):
    text = plan(QUERIES["split_explode"](spark, SMALL))
    assert text.count("from_xml(") == 1
    assert text.index("from_xml(") < text.index("Exchange")  # the tree's leaves come last


def test_reports_are_exchanged_before_they_are_counted(spark, tables):
    text = plan(QUERIES["parse_quality_by_day"](spark, SMALL))
    assert re.search(r"hashpartitioning\(service_date#\d+, vehicle_id#\d+, ts#\d+L?, \d+\), REPARTITION_BY_NUM", text)


def test_bridge_reads_the_timetable_once(spark, tables):
    # the join with the timetable keeps trips with a stop in the region by itself
    optimized = QUERIES["stop_route_bridge"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("LeftSemi") == 1
