"""Queries over deprivation, rank statistics and disruptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.operators import disruptions, equity, features, reports, statistics, warehouse
from timepoint.plans.binding import Tables
from timepoint.plans.registry import query
from timepoint.sources.storage import checkpointed


def dims(t: Tables) -> DataFrame:
    return warehouse.dim_route(t.routes, t.route_areas)


@query("route_deprivation", "select * from route_areas")
def _(t: Tables) -> DataFrame:
    return t.route_areas


@query("stops_per_route", "select * from stop_counts")
def _(t: Tables) -> DataFrame:
    return equity.stops_per_route(t.stop_routes)


@query("weather_by_band", "select * from band_weather", "precip_mm temp_c wind_kph")
def _(t: Tables) -> DataFrame:
    return features.weather_by_band(t.weather, t.settings)


@query("active_disruptions", "select * from active_disruptions")
def active_disruptions(t: Tables) -> DataFrame:
    return disruptions.active_disruptions(
        t.situations_latest, t.stop_routes, t.settings.study_dates
    )


@query("route_history_train_only", "select * from route_history", "route_hist_ontime_rate")
def _(t: Tables) -> DataFrame:
    return features.route_history_train_only(t.band_days, t.settings.train_dates)


def _squared_sql(z: str) -> str:
    """``statistics._squared`` as SQL."""
    return f"(cast({z} as bigint) % 2147483647) * (cast({z} as bigint) % 2147483647) % 2147483647"


_EQUITY_ROUTES = """select route_id, route_imd_decile as imd_decile, compliance_rate,
    mean_on_time, band_days from routes_rated join dim_route using (route_id)
    where route_imd_decile is not null and band_days >= 5"""


@query("route_equity_table", _EQUITY_ROUTES, "imd_decile compliance_rate mean_on_time")
def _(t: Tables) -> DataFrame:
    return statistics.route_equity_table(t.band_days, dims(t), t.settings)


_BY_DECILE = """select cast({whole} as int) as imd_decile, avg(compliant) as compliance_rate,
    avg(pct_on_time) as mean_on_time, count(*) as band_days
    from band_days join dim_route using (route_id) where route_imd_decile is not null
    group by 1"""


@query(
    "compliance_by_decile",
    _BY_DECILE.format(whole="trunc(route_imd_decile)"),
    "compliance_rate mean_on_time",
)
def _(t: Tables) -> DataFrame:
    return statistics.compliance_by_decile(t.band_days, dims(t))


@query(
    "compliance_by_decile_rounded",
    """select cast(round(route_imd_decile) as int) as imd_decile,
              avg(compliant) as compliance_rate, avg(pct_on_time) as mean_on_time,
              count(*) as band_days
       from band_days join dim_route using (route_id)
       where route_imd_decile is not null and time_band in ('am_peak', 'pm_peak')
         and service_date in (date '2024-01-02', date '2024-01-03', date '2024-01-04')
       group by 1""",
    "compliance_rate mean_on_time",
)
def _(t: Tables) -> DataFrame:
    chosen = reports.slice_filter(
        t.band_days, t.settings.study_dates[1:4], ["am_peak", "pm_peak"]
    )
    return statistics.compliance_by_decile(chosen, dims(t), rounded=True)


@query(
    "deprivation_gap",
    """with ends as (
           select round(avg(compliant) filter (route_imd_decile < 4), 4) as low,
                  round(avg(compliant) filter (route_imd_decile >= 8), 4) as high
           from band_days join dim_route using (route_id))
       select low as deciles_1_3_compliance, high as deciles_8_10_compliance,
              round(100e0 * (high - low), 2) as gap_percentage_points from ends""",
    "deciles_1_3_compliance deciles_8_10_compliance gap_percentage_points",
)
def _(t: Tables) -> DataFrame:
    return statistics.deprivation_gap(statistics.compliance_by_decile(t.band_days, dims(t)))


@query(
    "frequency_buckets",
    """select case when n_trips <= 2 then '1-2' when n_trips <= 5 then '3-5'
                   when n_trips <= 10 then '6-10' when n_trips <= 20 then '11-20'
                   else '20+' end as trips_per_band,
              round(avg(compliant), 4) as compliance, round(avg(pct_on_time), 4) as on_time,
              count(*) as n
       from band_days join dim_route using (route_id) where route_imd_decile is not null
       group by 1""",
    "compliance on_time",
)
def _(t: Tables) -> DataFrame:
    return statistics.frequency_buckets(t.band_days, dims(t))


def _average_rank_sql(value: str) -> str:
    return f"rank() over (order by {value}) + (count(*) over (partition by {value}) - 1) / 2e0"


@query(
    "spearman",
    f"""select round(corr(rx, ry), 4) as spearman_rho, count(*) as n
        from (select {_average_rank_sql('imd_decile')} as rx,
                     {_average_rank_sql('compliance_rate')} as ry
              from ({_EQUITY_ROUTES}))""",
    "spearman_rho",
)
def _(t: Tables) -> DataFrame:
    routes = statistics.route_equity_table(t.band_days, dims(t), t.settings)
    return statistics.spearman(routes, "imd_decile", "compliance_rate")


PERMUTATIONS = 10_000


@query(
    "permutation_pvalue",
    f"""with recursive units as ({_EQUITY_ROUTES}),
        ranked as materialized (
            select route_id, row_number() over (order by route_id) - 1 as slot,
                   count(*) over () as n, {_average_rank_sql('imd_decile')} as rx,
                   {_average_rank_sql('compliance_rate')} as ry from units),
        sides as (
            select n, a, (n + a - 1) // a as b
            from (select any_value(n) as n from ranked),
                 lateral (select unnest(range(greatest(2, (cast(round(sqrt(n)) as bigint) + 1) // 2),
                                              2 * cast(round(sqrt(n)) as bigint) + 1)) as a)
            order by a * ((n + a - 1) // a), a limit 1),
        starts as (
            select replicate, {_squared_sql(_squared_sql('(replicate * 1000003 + 11 * 7919 + 12345)').join(['(', ' + replicate)']))} as k
            from range(1, {PERMUTATIONS + 1}) as r(replicate)),
        steps(replicate, route_id, lft, rgt, j) as (
            select replicate, route_id, slot // b, slot % b, 0
            from ranked, sides, range(1, {PERMUTATIONS + 1}) as r(replicate)
            union all
            select s.replicate, route_id,
                   case when j = {statistics.ROUNDS} then (lft * b + rgt) // b else rgt end,
                   case when j = {statistics.ROUNDS} then rgt else
                   (lft + ((((rgt + 1) * ({_squared_sql('(k + j * 362437)')}) + ({_squared_sql('(k + (j + 1) * 362437)')})) % 2147483647) >> 7))
                       % (case when j % 2 = 0 then a else b end) end,
                   case when j = {statistics.ROUNDS} then 0 else j + 1 end
            from steps s, sides, starts
            where starts.replicate = s.replicate and (j < {statistics.ROUNDS} or lft * b + rgt >= n)),
        drawn as (
            select replicate, ry, lft * b + rgt as slot from steps join ranked using (route_id), sides
            where j = {statistics.ROUNDS} and lft * b + rgt < sides.n),
        rhos as (
            select replicate, corr(b.rx, drawn.ry) as rho
            from drawn join ranked b using (slot) group by replicate),
        seen as (select corr(rx, ry) as rho, count(*) as n from ranked)
        select round(any_value(seen.rho), 4) as spearman_rho,
               round(count(*) filter (round(abs(rhos.rho), 12) >= round(abs(seen.rho), 12))
                     / {PERMUTATIONS}, 5) as p_value_permutation,
               any_value(n) as n_routes
        from rhos, seen""",
    "spearman_rho p_value_permutation",
)
def _(t: Tables) -> DataFrame:
    routes = statistics.route_equity_table(t.band_days, dims(t), t.settings)
    return statistics.permutation_pvalue(
        routes, "route_id", "imd_decile", "compliance_rate", PERMUTATIONS
    )


@query(
    "frequency_confound",
    f"""with b as (
            select {_average_rank_sql('n_trips')} as rn, {_average_rank_sql('route_imd_decile')} as rd,
                   {_average_rank_sql('compliant')} as rc, {_average_rank_sql('pct_on_time')} as rp
            from band_days join dim_route using (route_id) where route_imd_decile is not null)
        select round(corr(rn, rd), 4) as rho_n_trips_vs_imd_decile,
               round(corr(rn, rc), 4) as rho_n_trips_vs_compliant,
               round(corr(rn, rp), 4) as rho_n_trips_vs_pct_on_time from b""",
    "rho_n_trips_vs_imd_decile rho_n_trips_vs_compliant rho_n_trips_vs_pct_on_time",
)
def _(t: Tables) -> DataFrame:
    return statistics.frequency_confound(t.band_days, dims(t))


@query("equity_report")
def _(t: Tables) -> DataFrame:
    return statistics.equity_report(t.band_days, checkpointed(dims(t)), t.settings)


@query(
    "disruptions_by_reason",
    """select reason, count(*) as n from situations_latest where reason is not null
       group by reason order by n desc, reason limit 10""",
)
def _(t: Tables) -> DataFrame:
    return reports.disruptions_by_reason(t.situations_latest)


@query(
    "disruption_kpis",
    """select count(*) as situations, cast(sum(wy_specific) as bigint) as region_specific,
              avg(planned) as planned_share,
              (select count(*) from disruption_stop) as stop_links from fact_disruption""",
    "planned_share",
)
def _(t: Tables) -> DataFrame:
    return reports.disruption_kpis(
        warehouse.fact_disruption(t.situations_latest),
        warehouse.bridge_disruption_stop(t.situations_latest, t.stops),
    )


@query(
    "disruption_list",
    """select situation_id, reason, planned, summary, validity_start, validity_end,
              n_affected_stops from fact_disruption""",
)
def _(t: Tables) -> DataFrame:
    return reports.disruption_list(warehouse.fact_disruption(t.situations_latest))


@query(
    "active_stop_routes",
    """select route_id, count(*) as stops from stop_routes
       where stop_id in (select stop_id from disruption_stop) group by route_id""",
)
def _(t: Tables) -> DataFrame:
    named = warehouse.bridge_disruption_stop(t.situations_latest, t.stops).select("stop_id")
    touched = t.stop_routes.join(named, "stop_id", "left_semi")
    return touched.groupBy("route_id").agg(F.count(F.lit(1)).alias("stops"))
