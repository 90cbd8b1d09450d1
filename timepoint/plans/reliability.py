"""Queries over reliability, headway and operation facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.operators import headway, operation, ranking, reliability, reports
from timepoint.plans.binding import Tables
from timepoint.plans.registry import query


@query("trip_rollup", "select * from trip_facts", "median_delay")
def _(t: Tables) -> DataFrame:
    return t.trip_facts


@query("route_band_day", "select * from band_days", "pct_on_time mean_trip_delay sd_trip_delay")
def _(t: Tables) -> DataFrame:
    return t.band_days


@query(
    "compliance_share",
    """select count(*) as band_days, cast(sum(compliant) as bigint) as compliant_band_days,
              avg(compliant) as compliant_share from band_days""",
    "compliant_share",
)
def _(t: Tables) -> DataFrame:
    return reliability.compliance_share(t.band_days)


@query("trip_durations", "select * from durations", "actual_dur_min")
def _(t: Tables) -> DataFrame:
    return reliability.trip_durations(t.delays, t.settings)


@query(
    "trip_durations_per_day",
    """select trip_id, route_id, service_date,
              (max(inferred_sec) - min(inferred_sec)) / 60e0 as actual_dur_min,
              count(*) as stops_seen
       from kept group by trip_id, route_id, service_date
       having count(*) >= 3 and max(inferred_sec) > min(inferred_sec)""",
    "actual_dur_min",
)
def _(t: Tables) -> DataFrame:
    return reliability.trip_durations(t.delays, t.settings, per_day=True)


def ttv(t: Tables) -> DataFrame:
    return reliability.travel_time_variability(
        reliability.trip_durations(t.delays, t.settings), t.settings
    )


@query("travel_time_variability", "select * from ttv", "mean_dur_min sd_dur_min ttv_cv")
def _(t: Tables) -> DataFrame:
    return ttv(t)


@query(
    "headway_scheduled",
    "select * from sched_headways",
    "sched_headway_mean_min sched_headway_sd_min",
)
def _(t: Tables) -> DataFrame:
    return t.sched_headways


@query(
    "headway_observed",
    "select * from obs_headways",
    "obs_headway_sd_min sched_headway_mean_min",
)
def _(t: Tables) -> DataFrame:
    return t.obs_headways


def checked(t: Tables) -> DataFrame:
    scheduled = operation.scheduled_trip_days(t.calendar, t.trips, t.settings.study_dates)
    return operation.scheduled_left_confirmed(scheduled, t.delays)


@query(
    "operation_floor_by_day",
    """select service_date, count(*) as scheduled, cast(sum(confirmed) as bigint) as confirmed,
              round(sum(confirmed) / count(*), 4) as avl_confirmed_rate
       from checked group by service_date""",
    "avl_confirmed_rate",
)
def _(t: Tables) -> DataFrame:
    return operation.operation_floor_by_day(checked(t))


@query(
    "operation_floor_by_operator",
    """select agency_id, count(*) as scheduled, cast(sum(confirmed) as bigint) as confirmed,
              round(sum(confirmed) / count(*), 4) as avl_confirmed_rate
       from checked left join routes using (route_id)
       group by agency_id having count(*) >= 100""",
    "avl_confirmed_rate",
)
def _(t: Tables) -> DataFrame:
    return operation.operation_floor_by_operator(checked(t), t.routes, t.settings)


@query(
    "operation_floor_total",
    """select count(*) as total_scheduled_trip_days,
              cast(sum(confirmed) as bigint) as total_avl_confirmed,
              round(sum(confirmed) / count(*), 4) as overall_avl_confirmed_rate from checked""",
    "overall_avl_confirmed_rate",
)
def _(t: Tables) -> DataFrame:
    return operation.operation_floor_total(checked(t))


def _window_sql(minutes: int) -> str:
    return f"""select '+/-{minutes} min' as window, count(*) as band_days,
        round(avg(cast(share >= 0.85e0 as int)), 4) as compliant_share,
        round(avg(share), 4) as mean_on_time
        from (select avg(on_time_{minutes}_{minutes}) as share from trip_facts
              where time_band is not null group by route_id, service_date, time_band)"""


@query(
    "sensitivity_windows",
    " union all ".join(_window_sql(m) for m in (2, 3, 5)),
    "compliant_share mean_on_time",
)
def _(t: Tables) -> DataFrame:
    return reliability.sensitivity_windows(t.trip_facts, t.settings)


@query(
    "worst_routes",
    """select route_id, route_short_name, compliance_rate, band_days
       from routes_rated join routes using (route_id)
       where band_days >= 3 order by compliance_rate, route_id limit 10""",
    "compliance_rate",
)
def worst_routes(t: Tables) -> DataFrame:
    return reports.worst_routes(t.band_days, t.routes, settings=t.settings)


@query(
    "average_rank",
    """select route_id, service_date, time_band, n_trips,
              rank() over (order by n_trips) + (count(*) over (partition by n_trips) - 1) / 2e0
                  as rank
       from band_days""",
    "rank",
)
def _(t: Tables) -> DataFrame:
    rows = t.band_days.select("route_id", "service_date", "time_band", "n_trips")
    return ranking.average_rank(rows, "n_trips")


@query(
    "top_k",
    """select trip_id, route_id, service_date, median_delay from trip_facts
       order by median_delay desc, trip_id, service_date limit 20""",
    "median_delay",
)
def _(t: Tables) -> DataFrame:
    rows = t.trip_facts.select("trip_id", "route_id", "service_date", "median_delay")
    return ranking.top_k(rows, 20, F.desc("median_delay"), "trip_id", "service_date")


@query("sort_output", "select vehicle_id, ts, trip_id from positions order by vehicle_id, ts")
def _(t: Tables) -> DataFrame:
    return ranking.sort_output(t.positions.select("vehicle_id", "ts", "trip_id"), "vehicle_id", "ts")




@query("scheduled_gaps", "select * from sched_gaps", "headway_min")
def _(t: Tables) -> DataFrame:
    events = headway.scheduled_events(t.stop_times, t.trips, t.settings)
    return headway.successive_gaps(events, "sched_sec", ["time_band"], t.settings).select(
        "route_id", "time_band", "headway_min"
    )
