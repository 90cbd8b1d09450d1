"""Queries over scalar expressions, filters, matching and the other joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.functions import buckets, columns, delays, geo, timeofday
from timepoint.operators import (
    disruptions,
    equity,
    features,
    headway,
    matching,
    operation,
    reliability,
    reports,
    spatial,
    statistics,
    warehouse,
)
from timepoint.plans.binding import Tables
from timepoint.plans.equity import active_disruptions
from timepoint.plans.oracle import DATES, IN_BOX, band, haversine, seconds, wrap
from timepoint.plans.registry import query
from timepoint.settings import DAY_NAMES

CENTRE = (53.765, -1.7)

# ------------------------------------------------------------------ scalar expressions


@query(
    "haversine_m",
    f"select stop_id, stop_name, {haversine('stop_lat', 'stop_lon', '53.765e0', '-1.7e0')} as dist_m from stops_raw",
    "dist_m",
)
def _(t: Tables) -> DataFrame:
    lat, lon = (F.lit(c) for c in CENTRE)
    return t.stops_raw.select(
        "stop_id",
        "stop_name",
        geo.haversine_m(F.col("stop_lat"), F.col("stop_lon"), lat, lon).alias("dist_m"),
    )


@query(
    "gtfs_seconds",
    f"""select arrival_time, cast({seconds('arrival_time')} as int) as sec, count(*) as n
        from stop_times_raw group by 1, 2""",
)
def _(t: Tables) -> DataFrame:
    sec = timeofday.gtfs_seconds(F.col("arrival_time"))
    return t.stop_times_raw.groupBy("arrival_time", sec.alias("sec")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "local_seconds_of_day",
    """select vehicle_id, cast(sum(ts % 86400) as bigint) as london,
              cast(sum((ts - 18000) % 86400) as bigint) as new_york
       from positions group by vehicle_id""",
)
def _(t: Tables) -> DataFrame:
    ts = F.col("ts_utc")
    return t.positions.groupBy("vehicle_id").agg(
        F.sum(timeofday.local_seconds_of_day(ts, "Europe/London")).alias("london"),
        F.sum(timeofday.local_seconds_of_day(ts, "America/New_York")).alias("new_york"),
    )


@query(
    "wrap_delay",
    f"""select vehicle_id, ts, cast({wrap('ts % 86400', '43200')} as bigint) as from_noon,
               cast({wrap('ts % 86400', '91800')} as bigint) as from_late,
               cast({wrap('ts', '0')} as bigint) as many_days
        from positions""",
)
def _(t: Tables) -> DataFrame:
    second = F.col("ts") % 86_400
    return t.positions.select(
        "vehicle_id",
        "ts",
        delays.wrap_delay(second, F.lit(43_200)).alias("from_noon"),
        delays.wrap_delay(second, F.lit(91_800)).alias("from_late"),
        delays.wrap_delay(F.col("ts"), F.lit(0)).alias("many_days"),
    )


@query(
    "delay_minutes",
    f"""select vehicle_id, ts, round({wrap('ts % 86400', '43200')} / 60e0, 2) as minutes
        from positions""",
    "minutes",
)
def _(t: Tables) -> DataFrame:
    wrapped = delays.wrap_delay(F.col("ts") % 86_400, F.lit(43_200))
    return t.positions.select("vehicle_id", "ts", delays.delay_minutes(wrapped).alias("minutes"))


_HOUR_SQL = f"({seconds('arrival_time')} // 3600 % 24)"


@query(
    "time_band",
    f"""select cast({_HOUR_SQL} as int) as hour, {band(_HOUR_SQL)} as time_band, count(*) as n
        from stop_times_raw group by 1, 2""",
)
def _(t: Tables) -> DataFrame:
    hour = timeofday.service_hour(timeofday.gtfs_seconds(F.col("arrival_time")))
    return t.stop_times_raw.groupBy(
        hour.alias("hour"), timeofday.time_band(hour, t.settings.time_bands).alias("time_band")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "service_hour",
    f"select cast({_HOUR_SQL} as int) as hour, count(*) as n from stop_times_raw group by 1",
)
def _(t: Tables) -> DataFrame:
    hour = timeofday.service_hour(timeofday.gtfs_seconds(F.col("arrival_time")))
    return t.stop_times_raw.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "day_name",
    """select cast(o_orderdate as date) as d, dayname(cast(o_orderdate as date)) as day_of_week,
              count(*) as n from orders group by 1, 2""",
)
def _(t: Tables) -> DataFrame:
    date = F.to_date("o_orderdate")
    return t.raw("orders").groupBy(
        date.alias("d"), timeofday.day_name(date).alias("day_of_week")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "is_weekend",
    """select cast(isodow(cast(o_orderdate as date)) >= 6 as int) as is_weekend, count(*) as n
       from orders group by 1""",
)
def _(t: Tables) -> DataFrame:
    weekend = timeofday.is_weekend(F.to_date("o_orderdate"))
    return t.raw("orders").groupBy(weekend.alias("is_weekend")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "calendar_date_int",
    """select cast(strftime(cast(o_orderdate as date), '%Y%m%d') as int) as yyyymmdd,
              lower(dayname(cast(o_orderdate as date))) as weekday, count(*) as n
       from orders group by 1, 2""",
)
def _(t: Tables) -> DataFrame:
    date = F.to_date("o_orderdate")
    return t.raw("orders").groupBy(
        timeofday.calendar_date_int(date).alias("yyyymmdd"),
        timeofday.weekday_column(date).alias("weekday"),
    ).agg(F.count(F.lit(1)).alias("n"))


_FLAGS = ", ".join(
    f"cast(delay_min between -{m} and {m} as int) as on_time_{m}_{m}" for m in (2, 3, 5)
)


@query("on_time_flags", f"select trip_id, service_date, stop_id, {_FLAGS} from delays")
def _(t: Tables) -> DataFrame:
    flags = delays.on_time_flags(F.col("delay_min"), t.settings.on_time_windows)
    return t.delays.select("trip_id", "service_date", "stop_id", *flags)


@query(
    "in_bbox",
    f"""select route_id, count(*) filter ({IN_BOX}) as inside,
               count(*) filter (not ({IN_BOX})) as outside from pings_all group by route_id""",
)
def _(t: Tables) -> DataFrame:
    inside = geo.in_bbox(F.col("lat"), F.col("lon"), t.settings.box)
    return t.pings_all.groupBy("route_id").agg(
        F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside")
    )


@query(
    "iso_date_prefix",
    """select situation_id, snapshot_id, cast(substr(validity_start, 1, 10) as date) as v_start,
              coalesce(cast(substr(validity_end, 1, 10) as date), date '2099-01-01') as v_end
       from situation_snapshots""",
)
def _(t: Tables) -> DataFrame:
    return disruptions.notice_dates(t.situation_snapshots).select(
        "situation_id", "snapshot_id", "v_start", "v_end"
    )


@query(
    "split_explode",
    """select situation_id, snapshot_id, unnest(string_split(wy_stop_refs, ',')) as stop_id
       from situation_snapshots where wy_stop_refs <> ''""",
)
def _(t: Tables) -> DataFrame:
    return disruptions.explode_refs(
        t.situation_snapshots.select("situation_id", "snapshot_id", "wy_stop_refs")
    )


@query(
    "bucket_right_closed",
    """select case when n_trips > 0 and n_trips <= 2 then '1-2' when n_trips <= 5 then '3-5'
                   when n_trips <= 10 then '6-10' when n_trips <= 20 then '11-20' else '20+' end
              as bucket, count(*) as n from band_days group by 1""",
)
def _(t: Tables) -> DataFrame:
    bucket = buckets.bucket_right_closed(
        F.col("n_trips"), buckets.TRIP_EDGES, buckets.TRIP_LABELS
    )
    return t.band_days.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "clip",
    """select l_orderkey, l_linenumber, greatest(least(l_quantity, 40e0), 10e0) as clipped
       from lineitem""",
    "clipped",
)
def _(t: Tables) -> DataFrame:
    clipped = buckets.clip(F.col("l_quantity"), 10.0, 40.0)
    return t.raw("lineitem").select("l_orderkey", "l_linenumber", clipped.alias("clipped"))


@query(
    "status_class",
    """select route_id, case when mean_on_time >= 0.85e0 then 'green'
                             when mean_on_time >= 0.6e0 then 'orange' else 'red' end as status,
              case when mean_on_time >= 0.7e0 then 'green'
                   when mean_on_time >= 0.45e0 then 'orange' else 'red' end as adjusted
       from routes_rated""",
)
def _(t: Tables) -> DataFrame:
    rate = F.avg("pct_on_time")
    return t.band_days.groupBy("route_id").agg(rate.alias("rate")).select(
        "route_id",
        buckets.status_class(F.col("rate")).alias("status"),
        buckets.status_class(F.col("rate"), 0.70, 0.45).alias("adjusted"),
    )


@query(
    "fill_defaults",
    """select lsoa_code, coalesce(imd_decile, -1) as imd_decile,
              coalesce(imd_score, 0e0) as imd_score, 0e0 as n_active_disruptions
       from areas left join deprivation using (lsoa_code)""",
    "imd_score n_active_disruptions",
)
def _(t: Tables) -> DataFrame:
    joined = t.areas.select("lsoa_code").join(t.deprivation, "lsoa_code", "left")
    return columns.fill_defaults(
        joined, {"imd_decile": -1, "imd_score": 0.0, "n_active_disruptions": 0.0}
    )


@query(
    "nan_to_null",
    """select l_linenumber, count(*) as n,
              count(case when l_discount > 0.05e0 then l_discount end) as known,
              sum(case when l_discount > 0.05e0 then l_discount end) as total
       from lineitem group by l_linenumber""",
    "total",
)
def _(t: Tables) -> DataFrame:
    holes = F.when(F.col("l_discount") > 0.05, F.col("l_discount")).otherwise(float("nan"))
    clean = t.raw("lineitem").withColumn("x", columns.nan_to_null(holes))
    return clean.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count("x").alias("known"), F.sum("x").alias("total")
    )


@query(
    "reindex_order",
    """select day_of_week, cast(isodow(min(service_date)) as bigint) as position, count(*) as n
       from band_days group by day_of_week""",
)
def _(t: Tables) -> DataFrame:
    position = buckets.display_rank(F.col("day_of_week"), DAY_NAMES)
    return (
        t.band_days.groupBy("day_of_week")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("day_of_week", position.cast("long").alias("position"), "n")
        .orderBy("position")
    )


@query(
    "pct_round",
    """select route_id, round(compliance_rate * 100e0, 1) as compliant_pct,
              round(mean_on_time * 100e0, 1) as on_time_pct from routes_rated""",
    "compliant_pct on_time_pct",
)
def _(t: Tables) -> DataFrame:
    return t.band_days.groupBy("route_id").agg(
        buckets.pct_round(F.avg("compliant")).alias("compliant_pct"),
        buckets.pct_round(F.avg("pct_on_time")).alias("on_time_pct"),
    )


@query(
    "discover_columns",
    """select cast(sum(on_time_2_2) as bigint) as on_time_2_2,
              cast(sum(on_time_3_3) as bigint) as on_time_3_3,
              cast(sum(on_time_5_5) as bigint) as on_time_5_5 from trip_facts""",
)
def _(t: Tables) -> DataFrame:
    flags = columns.discover_columns(t.trip_facts.columns, prefix="on_time_")
    return t.trip_facts.agg(*(F.sum(f).alias(f) for f in flags))


# ------------------------------------------------------------------ filters


@query(
    "pings_with_trip",
    """select count(*) as positions, count(trip_id) as with_trip,
              count(trip_id) / count(*) as share from positions""",
    "share",
)
def _(t: Tables) -> DataFrame:
    return matching.ping_trip_coverage(t.positions)


@query(
    "within_radius",
    "select service_date, count(*) as pairs, max(dist_m) as farthest from candidates group by 1",
    "farthest",
)
def _(t: Tables) -> DataFrame:
    return _candidates(t).groupBy("service_date").agg(
        F.count(F.lit(1)).alias("pairs"), F.max("dist_m").alias("farthest")
    )


@query(
    "drop_outliers",
    """select count(*) as raw_events, count(*) filter (abs(delay_min) <= 60) as kept_events,
              1e0 - count(*) filter (abs(delay_min) <= 60) / count(*) as dropped_share
       from delays""",
    "dropped_share",
)
def _(t: Tables) -> DataFrame:
    return reliability.outlier_summary(t.delays, t.settings)


@query(
    "in_some_band",
    """select trip_id, route_id, service_date, time_band from trip_facts
       where time_band is not null""",
)
def _(t: Tables) -> DataFrame:
    return reliability.in_some_band(t.trip_facts).select(
        "trip_id", "route_id", "service_date", "time_band"
    )


@query("measurable_durations", "select * from durations", "actual_dur_min")
def _(t: Tables) -> DataFrame:
    return reliability.trip_durations(t.delays, t.settings)


@query(
    "operating_gaps",
    """select route_id, time_band, count(*) as n, min(headway_min) as shortest,
              max(headway_min) as longest from obs_gaps group by route_id, time_band""",
    "shortest longest",
)
def _(t: Tables) -> DataFrame:
    return _observed_gaps(t).groupBy("route_id", "time_band").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("headway_min").alias("shortest"),
        F.max("headway_min").alias("longest"),
    )


@query(
    "having_min_support",
    "select route_id, band_days from routes_rated where band_days >= 5",
)
def _(t: Tables) -> DataFrame:
    counts = statistics.per_route_compliance(t.band_days)
    return reports.having_min_support(counts, "band_days", 5).select("route_id", "band_days")


@query(
    "parameterised_filter",
    """select day_of_week, avg(pct_on_time) as mean_on_time, count(*) as n
       from band_days where time_band = 'pm_peak' group by day_of_week""",
    "mean_on_time",
)
def _(t: Tables) -> DataFrame:
    return reports.compliance_for_band(t.spark, t.band_days, "pm_peak")


@query(
    "slice_filter",
    """select stop_id, on_time, n_events, imd_decile from stop_map
       where n_events >= 25 and (imd_decile between 2 and 8 or imd_decile is null)""",
    "on_time",
)
def _(t: Tables) -> DataFrame:
    stops = reports.stop_reliability(t.delays, t.stops, t.stop_areas, t.settings)
    return reports.stop_slice(stops, 25, (2, 8)).select(
        "stop_id", "on_time", "n_events", "imd_decile"
    )


@query(
    "anti_empty_refs",
    """select situation_id, snapshot_id from situation_snapshots
       where wy_specific and validity_start is not null""",
)
def _(t: Tables) -> DataFrame:
    return disruptions.named_stops_with_start(t.situation_snapshots).select(
        "situation_id", "snapshot_id"
    )


# ------------------------------------------------------------------ joins


@query("sched_with_coords", "select * from sched", "stop_lat stop_lon")
def _(t: Tables) -> DataFrame:
    return matching.sched_with_coords(t.stop_times, t.stops)


def _candidates(t: Tables) -> DataFrame:
    pings = matching.observed_second(matching.pings_with_trip(t.positions), t.settings.zone)
    return matching.scheduled_candidates(pings, t.stop_times, t.stops, t.settings)


@query(
    "ping_stop_candidates",
    """select trip_id, stop_id, route_id, service_date, cast(inferred_sec as int) as inferred_sec,
              stop_sequence, sched_sec, dist_m from candidates""",
    "dist_m",
)
def _(t: Tables) -> DataFrame:
    return _candidates(t).drop("lat", "lon", "stop_lat", "stop_lon")


@query(
    "semi_join_region",
    """select trip_id, count(*) as stops_in_region from stop_times_raw
       where stop_id in (select stop_id from stops) group by trip_id""",
)
def _(t: Tables) -> DataFrame:
    kept = t.stop_times_raw.join(t.stops.select("stop_id"), "stop_id", "left_semi")
    return kept.groupBy("trip_id").agg(F.count(F.lit(1)).alias("stops_in_region"))


def _checked(t: Tables) -> DataFrame:
    scheduled = operation.scheduled_trip_days(t.calendar, t.trips, t.settings.study_dates)
    return operation.scheduled_left_confirmed(scheduled, t.delays)


@query("scheduled_left_confirmed", "select * from checked")
def _(t: Tables) -> DataFrame:
    return _checked(t)


@query("active_services", "select * from trip_days")
def _(t: Tables) -> DataFrame:
    return operation.scheduled_trip_days(t.calendar, t.trips, t.settings.study_dates)


@query(
    "left_lookup_routes",
    "select trip_id, route_id, agency_id from trips_raw left join routes using (route_id)",
)
def _(t: Tables) -> DataFrame:
    return operation.left_lookup_routes(t.trips_raw.select("trip_id", "route_id"), t.routes)


@query("point_in_polygon", "select * from located")
def _(t: Tables) -> DataFrame:
    return spatial.point_in_polygon(t.stops, t.areas)


@query("area_attributes", "select * from stop_areas", "imd_score")
def _(t: Tables) -> DataFrame:
    return t.stop_areas


@query("stop_route_bridge", "select * from stop_routes")
def _(t: Tables) -> DataFrame:
    return t.stop_routes


@query(
    "validity_range_join",
    f"""select situation_id, service_date
        from (select situation_id, cast(substr(validity_start, 1, 10) as date) as v_start,
                     coalesce(cast(substr(validity_end, 1, 10) as date), date '2099-01-01')
                         as v_end from situations_latest)
        join {DATES} on service_date between v_start and v_end""",
)
def _(t: Tables) -> DataFrame:
    notices = disruptions.notice_dates(t.situations_latest).select(
        "situation_id", "v_start", "v_end"
    )
    return disruptions.validity_range_join(notices, t.settings.study_dates).drop(
        "v_start", "v_end"
    )


@query(
    "assemble_features",
    """select * from band_days left join stop_counts using (route_id)
       left join band_weather using (service_date, time_band)
       left join (select route_id, route_imd_decile from route_areas) using (route_id)
       left join route_history using (route_id)
       left join (select route_id, time_band, sched_headway_mean_min, sched_headway_sd_min
                  from sched_headways) using (route_id, time_band)
       left join active_disruptions using (route_id, service_date)""",
    "pct_on_time mean_trip_delay sd_trip_delay precip_mm temp_c wind_kph "
    "route_hist_ontime_rate sched_headway_mean_min sched_headway_sd_min",
)
def _(t: Tables) -> DataFrame:
    facts = features.with_route_history(t.band_days, t.settings.train_dates)
    # a band-day of no route has no route's history
    history = F.when(F.col("route_id").isNotNull(), F.col("route_hist_ontime_rate"))
    return features.assemble_features(
        facts.withColumn("route_hist_ontime_rate", history),
        (equity.stops_per_route(t.stop_routes), ["route_id"]),
        (features.weather_by_band(t.weather, t.settings), ["service_date", "time_band"]),
        (t.route_areas.select("route_id", "route_imd_decile"), ["route_id"]),
        (t.sched_headways.drop("n_headways"), ["route_id", "time_band"]),
        (active_disruptions(t), ["route_id", "service_date"]),
    )


@query(
    "star_join",
    """select route_id, service_date, time_band, compliant, operator, route_short_name,
              route_imd_decile from band_days join dim_route using (route_id)""",
    "route_imd_decile",
)
def _(t: Tables) -> DataFrame:
    facts = t.band_days.select("route_id", "service_date", "time_band", "compliant")
    return reports.star_join(facts, warehouse.dim_route(t.routes, t.route_areas))


@query(
    "known_stops_semi",
    "select situation_id, stop_id from refs where stop_id in (select stop_id from stops)",
)
def _(t: Tables) -> DataFrame:
    return warehouse.known_stops(warehouse.disruption_refs(t.situations_latest), t.stops).select(
        "situation_id", "stop_id"
    )


@query(
    "stop_dimension_joins",
    """select stop_id, n_events, stop_name, stop_lat, stop_lon, imd_decile
       from stop_on_time join stops using (stop_id) left join stop_areas using (stop_id)""",
    "stop_lat stop_lon",
)
def _(t: Tables) -> DataFrame:
    per_stop = t.delays.groupBy("stop_id").agg(F.count(F.lit(1)).alias("n_events"))
    return reports.stop_dimension_joins(per_stop, t.stops, t.stop_areas)


@query(
    "headway_vs_schedule",
    """select route_id, service_date, time_band, sched_headway_mean_min, headway_regular
       from obs_headways""",
    "sched_headway_mean_min",
)
def _(t: Tables) -> DataFrame:
    return t.obs_headways.select(
        "route_id", "service_date", "time_band", "sched_headway_mean_min", "headway_regular"
    )


# ------------------------------------------------------------------ ordering of matches


@query("nearest_ping", "select * from delays", "delay_min dist_m")
def _(t: Tables) -> DataFrame:
    return t.delays


def _observed_gaps(t: Tables) -> DataFrame:
    events = t.delays.withColumn(
        "time_band",
        timeofday.time_band(timeofday.service_hour(F.col("sched_sec")), t.settings.time_bands),
    )
    return headway.successive_gaps(
        reliability.in_some_band(events), "inferred_sec", ["service_date", "time_band"], t.settings
    )


@query("successive_gaps", "select * from obs_gaps", "headway_min")
def _(t: Tables) -> DataFrame:
    return _observed_gaps(t).drop("previous")


@query(
    "union_by_name",
    "select service_date, time_band, count(*) as n from band_days group by 1, 2",
)
def _(t: Tables) -> DataFrame:
    weekend = timeofday.is_weekend(F.col("service_date")) == 1
    one = t.band_days.filter(weekend).select("time_band", "service_date")
    two = t.band_days.filter(~weekend).select("service_date", "time_band")
    return one.unionByName(two).groupBy("service_date", "time_band").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("distinct", "select distinct service_date, trip_id from delays")
def _(t: Tables) -> DataFrame:
    return t.delays.select("service_date", "trip_id").distinct()


@query("drop_duplicates", "select stop_id, min(stop_name) as stop_name from stops_raw group by 1")
def _(t: Tables) -> DataFrame:
    from timepoint.operators.dedup import keep_first

    return keep_first(t.stops_raw.select("stop_id", "stop_name"), ["stop_id"])


