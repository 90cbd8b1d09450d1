"""SQL check of the registered queries: shared definitions and assembly.

The definitions rebuild every bound table in DuckDB SQL from the driver's tables, written
apart from the Spark code. A check names the tables it uses; only those are included.
Decimal literals carry an exponent so they are DOUBLE, as in the Spark plans.
"""

from __future__ import annotations

import re

ON_TIME = "between -2e0 and 2e0"


def _area_width(area: str) -> str:
    layer = f"({area} // 1000000)"
    return f"(0.00105e0 / (({layer} + 1) * ({layer} + 2)))"


def _area_west(area: str) -> str:
    layer = f"({area} // 1000000)"
    return (
        f"(-2.2507e0 + (({area} * 367) % 1000) * 0.00105e0"
        f" + 0.00105e0 * {layer} / ({layer} + 1))"
    )


def _area_south(area: str) -> str:
    return f"(53.531e0 + (({area} * 613 + {area} // 1000) % 1000) * 0.000467e0)"


def _stop_lon(k: str) -> str:
    return (
        f"({_area_west(f'({k} * 3 // 4)')} + (({k} * 37) % 113) / 100e0"
        f" * {_area_width(f'({k} * 3 // 4)')})"
    )


def _stop_lat(k: str) -> str:
    return f"({_area_south(f'({k} * 3 // 4)')} + (({k} * 53) % 109) / 100e0 * 0.000467e0)"


def _route(k: str) -> str:
    return f"(case when {k} % 3 = 0 then {k} // 150 - ({k} // 150) % 4 else {k} // 150 end)"


def band(hour: str) -> str:
    return (
        f"case when {hour} >= 7 and {hour} < 9 then 'am_peak' "
        f"when {hour} >= 9 and {hour} < 16 then 'inter_peak' "
        f"when {hour} >= 16 and {hour} < 19 then 'pm_peak' "
        f"when {hour} >= 19 and {hour} < 23 then 'evening' end"
    )


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2e0 * 6371000e0 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2e0), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin(radians({lon2} - {lon1}) / 2e0), 2)))"
    )


def wrap(observed: str, scheduled: str) -> str:
    raw = f"({observed} - {scheduled})"
    return f"(((({raw} + 43199) % 86400) + 86400) % 86400 - 43199)"


def seconds(text: str) -> str:
    return (
        f"(cast(split_part({text}, ':', 1) as int) * 3600 + "
        f"cast(split_part({text}, ':', 2) as int) * 60 + cast(split_part({text}, ':', 3) as int))"
    )


IN_BOX = "lat between 53.55e0 and 53.98e0 and lon between -2.2e0 and -1.2e0"
DATES = "(values " + ", ".join(f"(date '2024-01-0{d}')" for d in range(1, 8)) + ") as d(service_date)"
TRAIN = "service_date <= date '2024-01-05'"

# name -> SELECT; a definition may use any other by name
TABLES = {
    "stops_raw": f"""
        select 'S' || p_partkey as stop_id, 'Stop ' || p_partkey as stop_name,
               {_stop_lat('p_partkey')} as stop_lat, {_stop_lon('p_partkey')} as stop_lon
        from part
        union all
        select 'S' || p_partkey, 'Stop ' || p_partkey || ' bis',
               {_stop_lat('p_partkey')}, {_stop_lon('p_partkey')}
        from part where p_partkey % 3 = 0""",
    "stops": """
        select stop_id, min(stop_name) as stop_name, min(stop_lat) as stop_lat,
               min(stop_lon) as stop_lon
        from stops_raw
        where stop_lat between 53.55e0 and 53.98e0 and stop_lon between -2.2e0 and -1.2e0
        group by stop_id""",
    "routes_raw": """
        select 'R' || s_suppkey as route_id, 'OP' || (s_nationkey % 7) as agency_id,
               'Line ' || (s_suppkey + 100) as route_short_name
        from supplier
        union all
        select 'R' || s_suppkey, 'OP' || (s_nationkey % 7), 'Line ' || (s_suppkey + 100)
        from supplier where s_suppkey % 10 = 5""",
    "routes": "select distinct * from routes_raw",
    "trips_raw": f"""
        select 'T' || o_orderkey as trip_id, 'R' || {_route('o_orderkey')} as route_id,
               o_orderkey // 150 as service_id
        from orders""",
    "lines": f"""
        select *, rn * 20 + (l_partkey + l_linenumber) % 25 as k,
               18000 + ((l_orderkey * 37) % 1150) * 60 + l_linenumber * 240 as sched_sec
        from (select *, {_route('l_orderkey')} as rn from lineitem)""",
    "stop_times_raw": """
        select 'T' || l_orderkey as trip_id, 'S' || k as stop_id,
               l_linenumber as stop_sequence,
               lpad(cast(sched_sec // 3600 as varchar), 2, '0') || ':' ||
               lpad(cast(sched_sec % 3600 // 60 as varchar), 2, '0') || ':' ||
               lpad(cast(sched_sec % 60 as varchar), 2, '0') as arrival_time
        from lines""",
    "stop_times": """
        select distinct trip_id, stop_id, stop_sequence, arrival_time from stop_times_raw
        where stop_id in (select stop_id from stops)""",
    "trips": """
        select distinct * from trips_raw
        where trip_id in (select trip_id from stop_times)""",
    "calendar": """
        select s_suppkey as service_id,
        """
    + ", ".join(
        f"cast((s_suppkey + {i}) % 3 <> 0 as int) as {d}"
        for i, d in enumerate(
            "monday tuesday wednesday thursday friday saturday sunday".split()
        )
    )
    + """, 20231201 as start_date,
               case when s_suppkey % 9 = 8 then 20240103 else 20241231 end as end_date
        from supplier""",
    "pings_all": f"""
        select 'V' || l_suppkey as vehicle_id,
               case when l_partkey % 10 <> 0 then 'T' || l_orderkey end as trip_id,
               'R' || rn as route_id,
               {_stop_lat('k')} + ((l_partkey * 13) % 70) / 111195e0 as lat,
               {_stop_lon('k')} as lon,
               case when l_partkey % 4 <> 0 then cast(l_partkey % 360 as double) end as bearing,
               ts, cast(date '2024-01-01' + cast(day as int) as date) as service_date,
               ts // 60 as snapshot_id, l_partkey
        from (select *, 1704067200 + day * 86400 + sched_sec
                     + (cast(l_quantity as int) - 20) * 5 + (rn % 5) * 20
                     + case when l_tax = 0.08e0 and l_discount = 0.1e0 then 7200 else 0 end as ts
              from (select *, (l_orderkey + cast(l_linenumber = 7 as int)) % 7 as day from lines))""",
    "positions": f"select * exclude (snapshot_id, l_partkey) from pings_all where {IN_BOX}",
    "pings_repeated": """
        select * exclude (l_partkey) from pings_all
        union all
        select * exclude (l_partkey) replace (snapshot_id + 1 as snapshot_id)
        from pings_all where l_partkey % 3 = 0""",
    "weather": """
        select h as ts_local,
               case when hour(h) % 3 = 0 then 0e0 else (m * 7) % 25 / 10e0 end as precip_mm,
               (m * 11) % 120 / 10e0 as temp_c, (m * 5) % 300 / 10e0 as wind_kph,
               cast(h as date) as service_date, cast(hour(h) as int) as hour
        from (select date_trunc('hour', ts) as h, max(event_id) as m from events
              group by 1)""",
    "areas_raw": f"""
        select 'E' || c_custkey as lsoa_code, {_area_west('c_custkey')} as west,
               {_area_width('c_custkey')} as width,
               {_area_south('c_custkey')}
                   - case when c_custkey % 7 = 3 then 5e0 else 0e0 end as south
        from customer""",
    "areas": """
        select lsoa_code, west, west + width as east, south, south + 0.000467e0 as north
        from areas_raw
        where west <= -1.2e0 and west + width >= -2.2e0
          and south <= 53.98e0 and south + 0.000467e0 >= 53.55e0""",
    "deprivation": """
        select case when c_custkey % 17 = 5 then 'N' else 'E' end || c_custkey as lsoa_code,
               cast(1 + ((c_custkey // 15) * 3 + (c_custkey % 15) // 5) % 10 as int) as imd_decile,
               (c_custkey * 13) % 800 / 10e0 as imd_score
        from customer""",
    "situations_decoded": """
        select 'SIT' || (event_id // 12) as situation_id, 'P' || (user_id % 7) as participant,
               case when event_id % 3 = 0 then 'closed' else 'open' end as progress,
               event_type as reason,
               event_id % 2 = 0 as planned, 'Notice ' || event_id as summary,
               case when event_id % 11 <> 0
                    then strftime(ts, '%Y-%m-%d') || 'T00:00:00Z' end as validity_start,
               case when event_id % 5 <> 0
                    then strftime(cast(ts as date) + cast(event_id % 4 as int), '%Y-%m-%d')
                         || 'T23:00:00Z' end as validity_end,
               case when event_id % 4 = 0 then 0 when event_id % 4 = 1 then 1 else 2 end
                   as n_named,
               case when event_id % 4 = 0 then '' when event_id % 4 = 1 then 'X' || user_id
                    else 'S' || (event_id // 5) || ',S' || (event_id // 5 + 11) end
                   as stop_refs,
               'L' || (event_id % 13) as line_refs, 'OP' || (event_id % 7) as operator_refs,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') as fetched_at, event_id as snapshot_id
        from events""",
    "situation_snapshots": """
        select situation_id, participant, progress, reason, planned, summary, validity_start,
               validity_end, n_named as n_affected_stops, stop_refs as wy_stop_refs, line_refs,
               operator_refs, n_named = 2 as wy_specific, fetched_at, snapshot_id
        from situations_decoded where n_named <> 1""",
    "situations_latest": """
        select * exclude (place) from (
            select *, row_number() over (partition by situation_id
                                         order by fetched_at desc, snapshot_id desc) as place
            from situation_snapshots) where place = 1""",
    "sched": f"""
        select trip_id, stop_id, stop_sequence, stop_lat, stop_lon,
               {seconds('arrival_time')} as sched_sec
        from stop_times join stops using (stop_id)""",
    "candidates": f"""
        select trip_id, stop_id, p.route_id, p.service_date, p.ts % 86400 as inferred_sec,
               s.stop_sequence, s.sched_sec,
               {haversine('p.lat', 'p.lon', 's.stop_lat', 's.stop_lon')} as dist_m
        from positions p join sched s using (trip_id)
        where {haversine('p.lat', 'p.lon', 's.stop_lat', 's.stop_lon')} <= 50e0""",
    "delays": f"""
        select trip_id, route_id, service_date, stop_id, stop_sequence, sched_sec,
               cast(inferred_sec as int) as inferred_sec,
               round({wrap('inferred_sec', 'sched_sec')} / 60e0, 2) as delay_min, dist_m
        from (select *, row_number() over (
                  partition by trip_id, service_date, stop_id
                  order by round(dist_m, 3), inferred_sec, stop_sequence) as place
              from candidates) where place = 1""",
    "kept": "select * from delays where abs(delay_min) <= 60",
    "trip_facts": f"""
        select *, {band('hour')} as time_band, dayname(service_date) as day_of_week,
               cast(median_delay between -2 and 2 as int) as on_time_2_2,
               cast(median_delay between -3 and 3 as int) as on_time_3_3,
               cast(median_delay between -5 and 5 as int) as on_time_5_5
        from (select trip_id, route_id, service_date,
                     quantile_disc(delay_min, 0.5) as median_delay, count(*) as stops_observed,
                     min(sched_sec) as first_sched_sec,
                     cast(min(sched_sec) // 3600 % 24 as int) as hour
              from kept group by trip_id, route_id, service_date)""",
    "band_days": """
        select *, cast(pct_on_time >= 0.85e0 as int) as compliant
        from (select route_id, service_date, time_band, day_of_week, count(*) as n_trips,
                     avg(on_time_2_2) as pct_on_time, avg(median_delay) as mean_trip_delay,
                     stddev_samp(median_delay) as sd_trip_delay
              from trip_facts where time_band is not null
              group by route_id, service_date, time_band, day_of_week)""",
    "durations": """
        select trip_id, route_id, (max(inferred_sec) - min(inferred_sec)) / 60e0 as actual_dur_min,
               count(*) as stops_seen
        from kept group by trip_id, route_id
        having count(*) >= 3 and max(inferred_sec) > min(inferred_sec)""",
    "ttv": """
        select *, sd_dur_min / mean_dur_min as ttv_cv,
               cast(sd_dur_min / mean_dur_min <= 0.15e0 as int) as ttv_ok
        from (select route_id, avg(actual_dur_min) as mean_dur_min,
                     stddev_samp(actual_dur_min) as sd_dur_min, count(*) as n_trips_measured
              from durations group by route_id)""",
    "sched_gaps": f"""
        select * from (
            select route_id, time_band, (sched_sec - lag(sched_sec) over (
                       partition by route_id, stop_id, time_band order by sched_sec)) / 60e0
                       as headway_min
            from (select route_id, stop_id, {seconds('arrival_time')} as sched_sec,
                         {band(f"({seconds('arrival_time')} // 3600 % 24)")} as time_band
                  from stop_times join trips using (trip_id))
            where time_band is not null)
        where headway_min > 0 and headway_min <= 180""",
    "sched_headways": """
        select route_id, time_band, avg(headway_min) as sched_headway_mean_min,
               stddev_samp(headway_min) as sched_headway_sd_min, count(*) as n_headways
        from sched_gaps group by route_id, time_band""",
    "obs_gaps": f"""
        select * from (
            select route_id, stop_id, service_date, time_band, inferred_sec,
                   (inferred_sec - lag(inferred_sec) over (
                       partition by route_id, stop_id, service_date, time_band
                       order by inferred_sec)) / 60e0 as headway_min
            from (select *, {band('(sched_sec // 3600 % 24)')} as time_band from delays)
            where time_band is not null)
        where headway_min > 0 and headway_min <= 180""",
    "obs_headways": """
        select o.*, h.sched_headway_mean_min,
               cast(obs_headway_sd_min <= 0.2e0 * h.sched_headway_mean_min as int)
                   as headway_regular
        from (select route_id, service_date, time_band,
                     stddev_samp(headway_min) as obs_headway_sd_min, count(*) as n_obs
              from obs_gaps group by route_id, service_date, time_band) o
        left join sched_headways h using (route_id, time_band)""",
    "located": """
        select stop_id, lsoa_code from stops left join areas
        on stop_lon > west and stop_lon < east and stop_lat > south and stop_lat < north""",
    "stop_areas": """
        select stop_id, lsoa_code, imd_decile, imd_score
        from located left join deprivation using (lsoa_code)""",
    "stop_routes": "select distinct stop_id, route_id from stop_times join trips using (trip_id)",
    "route_areas": """
        select route_id, quantile_disc(imd_decile, 0.5) as route_imd_decile,
               min(imd_decile) as route_min_imd_decile,
               count(distinct stop_id) as n_stops_with_imd
        from (select distinct route_id, stop_id, imd_decile
              from stop_routes join stop_areas using (stop_id))
        group by route_id""",
    "dim_lsoa": """
        select distinct lsoa_code, imd_decile, imd_score from stop_areas
        where lsoa_code is not null""",
    "dim_stop": """
        select stop_id, stop_name as name, stop_lat as lat, stop_lon as lon, lsoa_code
        from stops left join stop_areas using (stop_id)""",
    "dim_route": """
        select route_id, agency_id as operator, route_short_name,
               cast(route_imd_decile as double) as route_imd_decile
        from routes left join route_areas using (route_id)""",
    "fact_trip": """
        select trip_id, route_id, service_date, time_band, day_of_week, stops_observed,
               median_delay, on_time_2_2 as on_time from trip_facts""",
    "fact_disruption": """
        select situation_id, reason, cast(planned as int) as planned, progress, summary,
               validity_start, validity_end, n_affected_stops,
               cast(wy_specific as int) as wy_specific from situations_latest""",
    "refs": """
        select situation_id, unnest(string_split(wy_stop_refs, ',')) as stop_id
        from situations_latest where wy_stop_refs <> ''""",
    "disruption_stop": """
        select distinct situation_id, stop_id from refs
        where stop_id in (select stop_id from stops)""",
    "active_services": f"""
        select service_id, service_date from calendar, {DATES}
        where case isodow(service_date) when 1 then monday when 2 then tuesday
                   when 3 then wednesday when 4 then thursday when 5 then friday
                   when 6 then saturday else sunday end = 1
          and start_date <= cast(strftime(service_date, '%Y%m%d') as int)
          and end_date >= cast(strftime(service_date, '%Y%m%d') as int)""",
    "trip_days": """
        select service_date, trip_id, route_id from trips join active_services using (service_id)""",
    "checked": """
        select t.*, case when m.trip_id is null then 0 else 1 end as confirmed
        from trip_days t left join (select distinct service_date, trip_id from delays) m
        on t.service_date = m.service_date and t.trip_id = m.trip_id""",
    "active_disruptions": f"""
        select route_id, service_date, count(distinct situation_id) as n_active_disruptions
        from (select situation_id, unnest(string_split(wy_stop_refs, ',')) as stop_id,
                     cast(substr(validity_start, 1, 10) as date) as v_start,
                     coalesce(cast(substr(validity_end, 1, 10) as date), date '2099-01-01')
                         as v_end
              from situations_latest where wy_specific and validity_start is not null)
        join stop_routes using (stop_id) join {DATES} on service_date between v_start and v_end
        group by route_id, service_date""",
    "stop_counts": """
        select route_id, count(distinct stop_id) as n_stops from stop_routes group by route_id""",
    "band_weather": f"""
        select service_date, time_band, avg(precip_mm) as precip_mm, avg(temp_c) as temp_c,
               avg(wind_kph) as wind_kph
        from (select *, {band('hour')} as time_band from weather)
        where time_band is not null group by service_date, time_band""",
    "route_history": f"""
        select route_id, avg(pct_on_time) as route_hist_ontime_rate from band_days
        where {TRAIN} group by route_id""",
    "features": f"""
        select b.*, coalesce(n_stops, 0) as n_stops, coalesce(precip_mm, 0e0) as precip_mm,
               temp_c, coalesce(wind_kph, 0e0) as wind_kph,
               coalesce(route_imd_decile, -1) as route_imd_decile,
               coalesce(route_hist_ontime_rate, 0e0) as route_hist_ontime_rate,
               coalesce(sched_headway_mean_min, 0e0) as sched_headway_mean_min,
               coalesce(sched_headway_sd_min, 0e0) as sched_headway_sd_min,
               coalesce(n_active_disruptions, 0) as n_active_disruptions,
               cast(day_of_week in ('Saturday', 'Sunday') as int) as is_weekend,
               cast({TRAIN} as int) as is_train
        from band_days b
        left join stop_counts using (route_id)
        left join band_weather using (service_date, time_band)
        left join route_areas using (route_id)
        left join route_history using (route_id)
        left join sched_headways using (route_id, time_band)
        left join active_disruptions using (route_id, service_date)""",
    "predictions": """
        select *, cast(score >= 0.5e0 as int) as prediction
        from (select 'model_' || m as model, doc_id as case_id, quality as label,
                     round(0.35e0 * quality + 0.65e0 * (((doc_id * 7919 * m) % 1000) / 1000e0), 3)
                         as score
              from labels, (values (1), (2), (3)) as v(m))""",
    "confusion": """
        select model, cast(sum(label * prediction) as bigint) as tp,
               cast(sum((1 - label) * (1 - prediction)) as bigint) as tn,
               cast(sum((1 - label) * prediction) as bigint) as fp,
               cast(sum(label * (1 - prediction)) as bigint) as fn
        from predictions group by model""",
    "steps": """
        select model, score, pos, neg, cast(sum(pos) over w as bigint) as tp,
               cast(sum(neg) over w as bigint) as fp,
               cast(sum(pos) over (partition by model) as bigint) as p,
               cast(sum(neg) over (partition by model) as bigint) as q
        from (select model, score, sum(label) as pos, sum(1 - label) as neg
              from predictions group by model, score)
        window w as (partition by model order by score desc rows unbounded preceding)""",
    "stop_on_time": f"""
        select stop_id, avg(cast(delay_min {ON_TIME} as int)) as on_time, count(*) as n_events
        from delays group by stop_id""",
    "stop_map": """
        select r.stop_id, on_time, n_events, stop_name, stop_lat, stop_lon, imd_decile,
               case when on_time >= 0.85e0 then 'green' when on_time >= 0.6e0 then 'orange'
                    else 'red' end as status
        from stop_on_time r join stops using (stop_id) left join stop_areas using (stop_id)
        where n_events >= 20""",
    "routes_rated": """
        select route_id, count(*) as band_days, avg(compliant) as compliance_rate,
               avg(pct_on_time) as mean_on_time, cast(sum(n_trips) as bigint) as trips
        from band_days group by route_id""",
}

_WORD = re.compile(r"[a-z_]+")


def _needed(sql: str, into: dict[str, None]) -> None:
    for word in _WORD.findall(sql):
        if word in TABLES and word not in into and TABLES[word] is not sql:
            _needed(TABLES[word], into)
            into[word] = None


def assemble(body: str, doubles: str, digits: int = 8) -> str:
    """Full SQL of one check; ``doubles`` names the columns compared to 8 decimals."""
    used: dict[str, None] = {}
    _needed(body, used)
    parts = [f"{name} as ({TABLES[name].strip()})" for name in used]
    parts.append(f"answer as ({body.strip()})")
    # adding zero turns -0.0 into 0.0
    rounded = ", ".join(f"round({c}, {digits}) + 0e0 as {c}" for c in doubles.split())
    columns = f"* replace ({rounded})" if rounded else "*"
    return "with " + ",\n".join(parts) + f"\nselect {columns} from answer"
