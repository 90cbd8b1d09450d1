"""Queries over profiles, report aggregates and dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.operators import operation, profile, reports, warehouse
from timepoint.plans.binding import Tables
from timepoint.plans.equity import active_disruptions, dims
from timepoint.plans.registry import query
from timepoint.sources.storage import checkpointed
from timepoint.plans.reliability import checked, ttv
from timepoint.operators.equity import stops_per_route
from timepoint.operators.features import feature_table


def feature_rows(t: Tables) -> DataFrame:
    return feature_table(
        t.band_days,
        stops_per_route(t.stop_routes),
        t.weather,
        t.route_areas,
        t.sched_headways,
        active_disruptions(t),
        t.settings,
    )


@query(
    "compliance_for_band",
    """select day_of_week, avg(pct_on_time) as mean_on_time, count(*) as n
       from band_days where time_band = 'am_peak' group by day_of_week""",
    "mean_on_time",
)
def _(t: Tables) -> DataFrame:
    return reports.compliance_for_band(t.spark, t.band_days, "am_peak")


@query(
    "routes_ranked",
    """select route_id, route_short_name, operator, round(route_imd_decile, 0) as imd_decile,
              band_days, trips, round(mean_on_time * 100e0, 1) as on_time_pct,
              round(compliance_rate * 100e0, 1) as compliant_pct
       from routes_rated left join dim_route using (route_id) where band_days >= 3""",
    "imd_decile on_time_pct compliant_pct",
)
def _(t: Tables) -> DataFrame:
    return reports.routes_ranked(t.band_days, dims(t), settings=t.settings)


@query(
    "busiest_routes",
    """select route_id, route_short_name, count(*) as trips, avg(on_time) as on_time
       from fact_trip join routes using (route_id) group by 1, 2
       order by trips desc, route_id limit 10""",
    "on_time",
)
def _(t: Tables) -> DataFrame:
    return reports.busiest_routes(warehouse.fact_trip(t.trip_facts), t.routes)


# every column of positions, and the column of the SQL table that has its NULLs
_NULLS = {
    c: c for c in "vehicle_id trip_id route_id lat lon bearing ts service_date".split()
} | {"ts_utc": "ts"}


@query(
    "null_profile",
    " union all ".join(
        f"""select '{c}' as "column", count(*) - count({own}) as nulls, count(*) as total
            from positions"""
        for c, own in _NULLS.items()
    ),
)
def _(t: Tables) -> DataFrame:
    return profile.null_profile(t.positions)


@query("approx_cardinality")
def _(t: Tables) -> DataFrame:
    return profile.approx_cardinality(t.stop_times, ["trip_id", "stop_id"])


def _moments_sql(column: str, source: str) -> str:
    return f"""with m as (select avg({column}) as mu, count({column}) as n from {source}),
        c as (select avg(pow({column} - mu, 2)) as m2, avg(pow({column} - mu, 3)) as m3,
                     avg(pow({column} - mu, 4)) as m4 from {source}, m)
        select mu as mean, (select quantile_disc({column}, 0.5) from {source}) as median,
               sqrt(m2 * n / (n - 1)) as std, m3 / pow(m2, 1.5e0) as skewness,
               m4 / (m2 * m2) - 3e0 as kurtosis from m, c"""


@query(
    "moments", _moments_sql("median_delay", "trip_facts"), "mean median std skewness kurtosis"
)
def _(t: Tables) -> DataFrame:
    return profile.moments(checkpointed(t.trip_facts.select("median_delay")), "median_delay")


@query(
    "moments_headway",
    _moments_sql("sched_headway_mean_min", "sched_headways"),
    "mean median std skewness kurtosis",
)
def _(t: Tables) -> DataFrame:
    return profile.moments(
        checkpointed(t.sched_headways.select("sched_headway_mean_min")), "sched_headway_mean_min"
    )


@query(
    "describe_profile",
    " union all ".join(
        f"""select '{c}' as "column", count({c}) as count, avg({c}) as mean,
                   stddev_samp({c}) as stddev, cast(min({c}) as double) as min,
                   cast(max({c}) as double) as max from trip_facts"""
        for c in ("median_delay", "stops_observed")
    ),
    "mean stddev min max",
)
def _(t: Tables) -> DataFrame:
    return profile.describe_profile(t.trip_facts, ["median_delay", "stops_observed"])


@query(
    "service_intensity",
    """select time_band, count(*) as route_bands, avg(sched_headway_mean_min) as mean_headway_min
       from sched_headways group by time_band""",
    "mean_headway_min",
)
def _(t: Tables) -> DataFrame:
    return profile.service_intensity(t.sched_headways)


def _on_time_sql(key: str, position: str) -> str:
    return f"""select cast({key} as varchar) as {key}, cast({position} as bigint) as position,
        avg(on_time_2_2) * 100e0 as on_time_pct, count(*) as n
        from trip_facts where {key} is not null group by {key}"""


_BAND_POSITION = (
    "list_position(['am_peak', 'inter_peak', 'pm_peak', 'evening'], time_band)"
)

for _key, _name, _position in (
    ("hour", "on_time_by_hour", "hour"),
    ("day_of_week", "on_time_by_day", "isodow(min(service_date))"),
    ("time_band", "on_time_by_band", _BAND_POSITION),
):

    def _(t: Tables, key: str = _key) -> DataFrame:
        return profile.on_time_by(t.trip_facts, key, t.settings)

    query(_name, _on_time_sql(_key, _position), "on_time_pct")(_)


@query(
    "on_time_profile",
    " union all ".join(
        f"""select '{k}' as "grouping", cast({k} as varchar) as value,
                   avg(on_time_2_2) * 100e0 as on_time_pct, count(*) as n
            from trip_facts where {k} is not null group by {k}"""
        for k in ("hour", "day_of_week", "time_band")
    ),
    "on_time_pct",
)
def _(t: Tables) -> DataFrame:
    return profile.on_time_profile(t.trip_facts, t.settings)


@query(
    "delay_by_stop_sequence",
    """select stop_sequence, median(delay_min) as median_delay, count(*) as n
       from delays where stop_sequence <= 40 group by stop_sequence""",
    "median_delay",
)
def _(t: Tables) -> DataFrame:
    return profile.delay_by_stop_sequence(t.delays)


def _histogram_sql(value: str, source: str, bins: int) -> str:
    return f"""with v as (select {value} as x from {source} where {value} is not null),
        e as (select min(x) as low, (max(x) - min(x)) / {bins}e0 as width from v),
        c as (select least(cast(floor((x - low) / width) as bigint), {bins - 1}) as bin,
                     count(*) as n from v, e group by 1)
        select b as bin, low + b * width as bin_low, low + (b + 1) * width as bin_high,
               coalesce(n, 0) as n
        from e, range(0, {bins}) as r(b) left join c on c.bin = r.b"""


@query(
    "histogram",
    _histogram_sql("greatest(least(delay_min, 20e0), -10e0)", "delays", 60),
    "bin_low bin_high",
)
def _(t: Tables) -> DataFrame:
    return profile.histogram(t.delays, "delay_min", 60, (-10.0, 20.0))


@query(
    "histogram_trip_delay",
    _histogram_sql("greatest(least(median_delay, 30e0), -10e0)", "trip_facts", 40),
    "bin_low bin_high",
)
def _(t: Tables) -> DataFrame:
    return profile.histogram(t.trip_facts, "median_delay", 40, (-10.0, 30.0))


@query(
    "histogram_headway",
    _histogram_sql("greatest(least(sched_headway_mean_min, 120e0), 0e0)", "sched_headways", 48),
    "bin_low bin_high",
)
def _(t: Tables) -> DataFrame:
    return profile.histogram(t.sched_headways, "sched_headway_mean_min", 48, (0.0, 120.0))


@query(
    "histogram_match_distance",
    _histogram_sql("round(dist_m * 1000e0)", "delays", 50),
    "bin_low bin_high",
)
def _(t: Tables) -> DataFrame:
    # whole millimetres: distances of 0 m, 1 m, ... fall on bin edges
    millimetres = t.delays.withColumn("dist_mm", F.round(F.col("dist_m") * 1000))
    return profile.histogram(millimetres, "dist_mm", 50)


@query(
    "class_balance",
    """select label, count(b.compliant) as n, count(b.compliant) / (select count(*) from band_days)
              as share
       from (values (0), (1)) as v(label) left join band_days b on b.compliant = label
       group by label""",
    "share",
)
def _(t: Tables) -> DataFrame:
    return profile.class_balance(t.band_days)


@query(
    "on_time_by_rain",
    """select case when precip_mm <= 0 then 'dry' when precip_mm <= 0.5e0 then 'drizzle'
                   when precip_mm <= 2 then 'light' else 'wet' end as rain,
              avg(pct_on_time) * 100e0 as on_time_pct, count(*) as n
       from features group by 1""",
    "on_time_pct",
)
def _(t: Tables) -> DataFrame:
    return reports.on_time_by_rain(feature_rows(t))


CORRELATED = (
    "pct_on_time",
    "n_trips",
    "n_stops",
    "sched_headway_mean_min",
    "route_imd_decile",
    "route_hist_ontime_rate",
    "precip_mm",
    "n_active_disruptions",
    "compliant",
)


@query(
    "correlation_matrix",
    " union all ".join(
        f"""select '{a}' as a, '{b}' as b,
                   case when max({a}) > min({a}) and max({b}) > min({b})
                        then corr({a}, {b}) end as correlation from features"""
        for a in CORRELATED
        for b in CORRELATED
    ),
    "correlation",
)
def _(t: Tables) -> DataFrame:
    return profile.correlation_matrix(feature_rows(t), CORRELATED)


@query(
    "box_stats_by_band",
    """with v as (select time_band, greatest(least(median_delay, 20e0), -10e0) as x
                  from trip_facts where time_band is not null),
        q as (select time_band, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as median,
                     quantile_cont(x, 0.75) as q3, count(*) as n from v group by time_band)
        select time_band, q1, median, q3, min(x) as whisker_low, max(x) as whisker_high, n
        from v join q using (time_band)
        where x between round(q1 - 1.5e0 * (q3 - q1), 9) and round(q3 + 1.5e0 * (q3 - q1), 9)
        group by time_band, q1, median, q3, n""",
    "q1 median q3 whisker_low whisker_high",
)
def _(t: Tables) -> DataFrame:
    return profile.box_stats(t.trip_facts, "time_band", "median_delay")


@query("stop_reliability", "select * from stop_map", "on_time stop_lat stop_lon")
def stop_map(t: Tables) -> DataFrame:
    return reports.stop_reliability(t.delays, t.stops, t.stop_areas, t.settings)


@query(
    "stop_map_kpis",
    """select count(*) as stops_shown, avg(on_time) as mean_on_time,
              avg(cast(on_time >= 0.85e0 as int)) as share_at_threshold,
              cast(sum(n_events) as bigint) as matched_passes
       from stop_map where imd_decile between 1 and 10 or imd_decile is null""",
    "mean_on_time share_at_threshold",
)
def _(t: Tables) -> DataFrame:
    return reports.stop_map_kpis(reports.stop_slice(stop_map(t)))


@query(
    "worst_stops",
    """select stop_id, stop_name, round(on_time * 100e0, 1) as on_time_pct, n_events, imd_decile
       from stop_map order by on_time, stop_id limit 25""",
    "on_time_pct",
)
def _(t: Tables) -> DataFrame:
    return reports.worst_stops(reports.stop_slice(stop_map(t)))


_DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


@query(
    "band_day_pivot",
    "select time_band, "
    + ", ".join(
        f"round(avg(compliant) filter (day_of_week = '{d}') * 100e0, 1) as \"{d}\"" for d in _DAYS
    )
    + f", cast({_BAND_POSITION} as int) as position from band_days group by time_band",
    " ".join(_DAYS),
)
def _(t: Tables) -> DataFrame:
    return reports.band_day_pivot(t.band_days, t.settings)


@query(
    "delay_quantiles",
    """select median(delay_min) as median_delay, quantile_cont(delay_min, 0.9) as p90_delay,
              avg(cast(delay_min between -2 and 2 as int)) as within_window from delays""",
    "median_delay p90_delay within_window",
)
def _(t: Tables) -> DataFrame:
    return profile.delay_quantiles(t.delays, t.settings)


@query(
    "overview_kpis",
    """select count(*) as band_days, (select count(*) from trip_facts) as trips_observed,
              avg(compliant) as compliant_share,
              (select avg(on_time_2_2) from trip_facts) as trips_on_time_share,
              (select avg(headway_regular) from obs_headways) as headway_regular_share,
              (select avg(ttv_ok) from ttv) as ttv_ok_share,
              (select round(sum(confirmed) / count(*), 4) from checked) as avl_floor
       from band_days""",
    "compliant_share trips_on_time_share headway_regular_share ttv_ok_share avl_floor",
)
def _(t: Tables) -> DataFrame:
    t.pin("delays", "trip_facts", "sched_headways")
    return reports.overview_kpis(
        t.band_days,
        t.trip_facts,
        ttv(t),
        t.obs_headways,
        operation.operation_floor_total(checked(t)),
        t.settings,
    )


@query(
    "ttv_headway_summary",
    """select (select avg(headway_regular) from obs_headways) as headway_regular_share,
              avg(ttv_ok) as ttv_ok_share, median(ttv_cv) as median_ttv_cv from ttv""",
    "headway_regular_share ttv_ok_share median_ttv_cv",
)
def _(t: Tables) -> DataFrame:
    t.pin("delays")
    return reports.ttv_headway_summary(checkpointed(ttv(t).select("ttv_ok", "ttv_cv")), t.obs_headways)


@query(
    "data_funnel",
    """select 1 as position, 'raw pings' as stage, count(*) as records from pings_repeated
       union all select 2, 'after deduplication', count(distinct (vehicle_id, ts))
       from pings_repeated
       union all select 3, 'matched stop events', count(*) from delays
       union all select 4, 'trip-day facts', count(*) from trip_facts
       union all select 5, 'route-band-days', count(*) from band_days""",
)
def _(t: Tables) -> DataFrame:
    return profile.stage_counts(
        {
            "raw pings": t.pings_repeated,
            "after deduplication": t.pings_repeated.select("vehicle_id", "ts").distinct(),
            "matched stop events": t.delays,
            "trip-day facts": t.trip_facts,
            "route-band-days": t.band_days,
        }
    )


@query(
    "slice_kpis",
    """select count(*) as band_days, avg(compliant) as compliant_share,
              avg(pct_on_time) as mean_on_time from band_days
       where service_date <= date '2024-01-03' and time_band in ('inter_peak', 'evening')""",
    "compliant_share mean_on_time",
)
def _(t: Tables) -> DataFrame:
    chosen = reports.slice_filter(
        t.band_days, t.settings.study_dates[:3], ["inter_peak", "evening"]
    )
    return reports.slice_kpis(chosen)


@query(
    "stop_classes",
    "select status, count(*) as n from stop_map group by status",
)
def _(t: Tables) -> DataFrame:
    return stop_map(t).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
