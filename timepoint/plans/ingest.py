"""Queries over sources, sinks and the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.operators import operation, profile, warehouse
from timepoint.plans import landing
from timepoint.plans.binding import Tables
from timepoint.plans.oracle import IN_BOX
from timepoint.plans.registry import query
from timepoint.sources import gtfs, positions, situations, storage
from timepoint.sources.gtfs import WEEKDAYS
from timepoint.streaming.positions import new_folder

DAYS = ", ".join(WEEKDAYS)


@query("stops_in_region", "select * from stops", "stop_lat stop_lon")
def _(t: Tables) -> DataFrame:
    return t.stops


@query("routes_dedup", "select * from routes")
def _(t: Tables) -> DataFrame:
    return t.routes


@query("stop_times_in_region", "select * from stop_times")
def _(t: Tables) -> DataFrame:
    return t.stop_times


@query("trips_touching_region", "select * from trips")
def _(t: Tables) -> DataFrame:
    return t.trips


@query(
    "read_calendar",
    f"""select service_id, {DAYS},
               cast(strptime(cast(start_date as varchar), '%Y%m%d') as date) as valid_from,
               cast(strptime(cast(end_date as varchar), '%Y%m%d') as date) as valid_to
        from calendar""",
)
def _(t: Tables) -> DataFrame:
    return gtfs.calendar_validity(t.calendar)


@query("polygons_in_bbox", "select lsoa_code, west, east, south, north from areas", "west east south north")
def _(t: Tables) -> DataFrame:
    from timepoint.operators.spatial import with_extent

    return with_extent(t.areas).drop("rings")


@query("weather_hourly", "select * from weather", "precip_mm temp_c wind_kph")
def _(t: Tables) -> DataFrame:
    return t.weather


UTC_TIME = "timestamp_ntz '1970-01-01' + make_dt_interval(0, 0, 0, ts)"


@query(
    "dedup_pings",
    """select vehicle_id, ts, trip_id, route_id, lat, lon, bearing, service_date,
              make_timestamp(ts * 1000000) as utc_time
       from (select *, row_number() over (
                 partition by vehicle_id, ts
                 order by trip_id nulls last, snapshot_id, route_id, lat, lon,
                          bearing nulls first, service_date) as place
             from pings_repeated) where place = 1""",
    "lat lon bearing",
)
def _(t: Tables) -> DataFrame:
    return positions.dedup_pings(t.pings_repeated).select(
        "vehicle_id",
        "ts",
        "trip_id",
        "route_id",
        "lat",
        "lon",
        "bearing",
        "service_date",
        F.expr(UTC_TIME).alias("utc_time"),
    )


@query(
    "parse_quality_by_day",
    f"""with flagged as (
            select *, ({IN_BOX}) as inside from pings_repeated where snapshot_id % 50 <> 7),
        reports as (
            select service_date, vehicle_id, ts, count(*) filter (inside) as n,
                   count(*) filter (not inside) as out,
                   max(cast(inside and trip_id is not null as int)) as named
            from flagged group by 1, 2, 3),
        days as (
            select service_date, cast(sum(n) as bigint) as raw_pings,
                   count(*) filter (n > 0) as deduped_pings,
                   cast(sum(out) as bigint) as out_of_bbox,
                   cast(sum(named) as bigint) as with_trip_id
            from reports group by 1),
        files as (
            select service_date, count(distinct snapshot_id) as snapshots,
                   count(distinct snapshot_id) filter (snapshot_id % 50 = 7) as corrupt_snapshots
            from pings_repeated group by 1)
        select service_date, snapshots, corrupt_snapshots, raw_pings, deduped_pings, out_of_bbox,
               with_trip_id, round(1e0 - deduped_pings / raw_pings, 4) as duplicate_share,
               round(with_trip_id / deduped_pings, 4) as trip_id_share
        from files join days using (service_date)""",
    "duplicate_share trip_id_share",
)
def _(t: Tables) -> DataFrame:
    # polls at minutes ending in 7 of each 50 count as unreadable
    corrupt = F.col("snapshot_id") % 50 == 7
    files = (
        t.pings_repeated.select("service_date", "snapshot_id")
        .distinct()
        .withColumn("status", F.when(corrupt, "corrupt").otherwise("ok"))
    )
    return positions.parse_quality_by_day(
        t.pings_repeated.filter(~corrupt), t.settings.box, files
    )


def _named(t: Tables) -> DataFrame:
    """Reports with the name of the poll that landed them: date and minute."""
    return t.pings_all.withColumn("source", F.expr("service_date || '/' || (ts div 60)"))


@query(
    "decode_position_snapshots",
    """select vehicle_id, ts, trip_id, route_id, cast(cast(lat as float) as double) as lat,
              cast(cast(lon as float) as double) as lon, bearing
       from pings_all""",
    "lat lon bearing",
)
def _(t: Tables) -> DataFrame:
    decoded = positions.decode_position_snapshots(landing.encode_snapshots(_named(t)))
    return positions.decoded_pings(decoded).drop("source", "ts_utc")


def _damaged(t: Tables) -> DataFrame:
    """Encoded snapshots plus a cut-off copy of those whose number ends in 3."""
    whole = landing.encode_snapshots(_named(t))
    cut = whole.filter("source like '%3'").select(
        F.concat("source", F.lit("-cut")).alias("source"),
        F.expr("substring(content, 1, length(content) - 3)").alias("content"),
    )
    return whole.unionByName(cut)


_POLLS = "select distinct service_date || '/' || (ts // 60) as source from pings_all"


@query(
    "snapshot_quarantine",
    f"select source || '-cut' as source, 'corrupt' as status from ({_POLLS}) where source like '%3'",
)
def _(t: Tables) -> DataFrame:
    return positions.snapshot_quarantine(positions.decode_position_snapshots(_damaged(t)))


@query(
    "count_raw_positions",
    f"""select count(*) + count(*) filter (source like '%3') as snapshots,
               (select count(*) from pings_all) as vehicle_positions
        from ({_POLLS})""",
)
def _(t: Tables) -> DataFrame:
    return positions.count_raw_positions(positions.decode_position_snapshots(_damaged(t)))


@query(
    "decode_situations",
    "select * exclude (n_named) from situations_decoded",
)
def _(t: Tables) -> DataFrame:
    return t.situations_decoded.select(
        "situation_id",
        "participant",
        "progress",
        "reason",
        "planned",
        "summary",
        "validity_start",
        "validity_end",
        F.array_join("stop_refs", ",").alias("stop_refs"),
        F.array_join("line_ref_list", ",").alias("line_refs"),
        F.array_join("operator_ref_list", ",").alias("operator_refs"),
        "fetched_at",
        "snapshot_id",
    )


@query("filter_situations_region", "select * from situation_snapshots")
def _(t: Tables) -> DataFrame:
    return t.situation_snapshots


@query("latest_situation", "select * from situations_latest")
def _(t: Tables) -> DataFrame:
    return t.situations_latest


@query(
    "append_situation_snapshot",
    "select substr(fetched_at, 1, 10) as fetched_on, count(*) as n from situation_snapshots group by 1",
)
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "snapshots")
    even = F.col("snapshot_id") % 2 == 0
    situations.append_situation_snapshot(t.situation_snapshots.filter(even), path)
    situations.append_situation_snapshot(t.situation_snapshots.filter(~even), path)
    stored = storage.scan_partitioned(t.spark, path)
    return stored.groupBy(F.substring("fetched_at", 1, 10).alias("fetched_on")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "scan_partitioned",
    """select trip_id, route_id, stops_observed, median_delay from trip_facts
       where service_date = date '2024-01-03'""",
    "median_delay",
)
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "trips")
    storage.write_partitioned(t.trip_facts, path)
    return storage.scan_partitioned(t.spark, path, "service_date = date '2024-01-03'").select(
        "trip_id", "route_id", "stops_observed", "median_delay"
    )


@query(
    "write_partitioned",
    "select service_date, count(*) as pings, count(trip_id) as with_trip from positions group by 1",
)
def _(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "positions")
    storage.write_partitioned(t.positions, path)
    # writing one day again replaces that day only
    storage.write_partitioned(t.positions.filter("service_date = date '2024-01-02'"), path)
    return storage.scan_partitioned(t.spark, path).groupBy("service_date").agg(
        F.count(F.lit(1)).alias("pings"), F.count("trip_id").alias("with_trip")
    )


@query(
    "write_result",
    """select service_date, count(*) as scheduled, cast(sum(confirmed) as bigint) as confirmed,
              round(sum(confirmed) / count(*), 4) as avl_confirmed_rate
       from checked group by service_date""",
    "avl_confirmed_rate",
)
def _(t: Tables) -> DataFrame:
    checked = operation.scheduled_left_confirmed(
        operation.scheduled_trip_days(t.calendar, t.trips, t.settings.study_dates), t.delays
    )
    result = operation.operation_floor_by_day(checked)
    path = new_folder(t.spark, "result")
    storage.write_result(result, path, "csv")
    return t.spark.read.schema(result.schema).option("header", True).csv(path)


def warehouse_tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "dim_lsoa": warehouse.dim_lsoa(t.stop_areas),
        "dim_route": warehouse.dim_route(t.routes, t.route_areas),
        "dim_stop": warehouse.dim_stop(t.stops, t.stop_areas),
        "fact_trip_delay": warehouse.fact_trip(t.trip_facts),
        "fact_route_band_day": warehouse.fact_route_band_day(t.band_days),
        "fact_disruption": warehouse.fact_disruption(t.situations_latest),
        "disruption_stop": warehouse.disruption_refs(t.situations_latest).select(
            "situation_id", "stop_id"
        ),
    }


@query("warehouse_dim_lsoa", "select * from dim_lsoa", "imd_score")
def _(t: Tables) -> DataFrame:
    return warehouse.dim_lsoa(t.stop_areas)


@query("warehouse_dim_stop", "select * from dim_stop", "lat lon")
def _(t: Tables) -> DataFrame:
    return warehouse.dim_stop(t.stops, t.stop_areas)


@query("warehouse_dim_route", "select * from dim_route", "route_imd_decile")
def _(t: Tables) -> DataFrame:
    return warehouse.dim_route(t.routes, t.route_areas)


@query("warehouse_fact_trip", "select * from fact_trip", "median_delay")
def _(t: Tables) -> DataFrame:
    return warehouse.fact_trip(t.trip_facts)


@query(
    "warehouse_fact_route_band_day",
    "select * exclude (mean_trip_delay) from band_days",
    "pct_on_time sd_trip_delay",
)
def _(t: Tables) -> DataFrame:
    return warehouse.fact_route_band_day(t.band_days)


@query("warehouse_fact_disruption", "select * from fact_disruption")
def _(t: Tables) -> DataFrame:
    return warehouse.fact_disruption(t.situations_latest)


@query("bridge_disruption_stop", "select * from disruption_stop")
def _(t: Tables) -> DataFrame:
    return warehouse.bridge_disruption_stop(t.situations_latest, t.stops)


@query(
    "bridge_match_counts",
    "select (select count(*) from refs) as refs, (select count(*) from disruption_stop) as matched",
)
def _(t: Tables) -> DataFrame:
    return warehouse.bridge_match_counts(t.situations_latest, t.stops)


@query(
    "upsert_last_wins",
    """select situation_id, summary, fetched_at from (
           select *, row_number() over (partition by situation_id
                                        order by snapshot_id % 2 desc, fetched_at desc,
                                                 snapshot_id desc) as place
           from situation_snapshots) where place = 1""",
)
def _(t: Tables) -> DataFrame:
    # even-numbered snapshots are the stored table, odd-numbered ones arrive afterwards
    odd = F.col("snapshot_id") % 2 == 1
    return warehouse.upsert_last_wins(
        t.situation_snapshots.filter(~odd),
        t.situation_snapshots.filter(odd),
        ["situation_id"],
        ["fetched_at", "snapshot_id"],
    ).select("situation_id", "summary", "fetched_at")


@query(
    "fk_violations",
    """select 'dim_stop' as table_name, 'lsoa_code' as column_name, count(*) as violations
       from dim_stop where lsoa_code is not null
            and lsoa_code not in (select lsoa_code from dim_lsoa)
       union all
       select 'fact_trip_delay', 'route_id', count(*) from fact_trip
       where route_id is not null and route_id not in (select route_id from dim_route)
       union all
       select 'fact_route_band_day', 'route_id', count(*) from band_days
       where route_id is not null and route_id not in (select route_id from dim_route)
       union all
       select 'disruption_stop', 'situation_id', count(*) from refs
       where situation_id not in (select situation_id from fact_disruption)
       union all
       select 'disruption_stop', 'stop_id', count(*) from refs
       where stop_id not in (select stop_id from dim_stop)""",
)
def _(t: Tables) -> DataFrame:
    t.pin("trip_facts", "situations_latest", "stop_areas")
    return warehouse.fk_violations(warehouse_tables(t))


def _pk_sql(name: str, source: str, keys: str) -> str:
    return (
        f"select '{name}' as table_name, count(*) as repeated_keys, "
        f"cast(coalesce(sum(n - 1), 0) as bigint) as surplus_rows "
        f"from (select {keys}, count(*) as n from {source} group by {keys}) where n > 1"
    )


@query(
    "pk_violations",
    " union all ".join(
        (
            _pk_sql("dim_lsoa", "dim_lsoa", "lsoa_code"),
            _pk_sql("dim_route", "routes_raw", "route_id"),
            _pk_sql("dim_stop", "stops_raw", "stop_id"),
            _pk_sql("fact_trip_delay", "fact_trip", "trip_id, service_date"),
            _pk_sql("fact_route_band_day", "band_days", "route_id, service_date, time_band"),
            _pk_sql("fact_disruption", "situation_snapshots", "situation_id"),
            _pk_sql("disruption_stop", "refs", "situation_id, stop_id"),
        )
    ),
)
def _(t: Tables) -> DataFrame:
    # raw feeds stand in for some tables, so that there is something to report
    tables = warehouse_tables(t) | {
        "dim_route": t.routes_raw,
        "dim_stop": t.stops_raw,
        "fact_disruption": t.situation_snapshots,
    }
    return warehouse.pk_violations(tables)


_COUNTED = (
    "stop_times", "trips", "stops", "routes", "deprivation", "areas", "weather", "stop_areas",
    "sched_headways", "situation_snapshots", "positions", "delays",
)


@query(
    "record_counts",
    "with c as ("
    + " union all ".join(f"select '{n}' as dataset, count(*) as records from {n}" for n in _COUNTED)
    + """ union all select 'snapshots', count(distinct snapshot_id) from pings_all)
    select * from c union all
    select 'TOTAL', cast(sum(records) as bigint) from c where dataset <> 'snapshots'""",
)
def _(t: Tables) -> DataFrame:
    datasets = {name: getattr(t, name) for name in _COUNTED}
    datasets["snapshots"] = t.pings_all.select("snapshot_id").distinct()
    return profile.record_counts(datasets, not_summed=["snapshots"])
