"""The transit tables, derived by projection from the driver's generic tables.

Every formula is integer arithmetic followed by double arithmetic, row by row, so each
transit table grows with the table it comes from and an independent engine can rebuild it
from the same text (see ``plans/oracle.py``). No binding joins or shuffles except where
repeats have to be removed.

    supplier -> routes, service calendars      part     -> stops (two feed copies)
    orders   -> trips                          customer -> areas and their deprivation
    lineitem -> stop times, vehicle pings      events   -> weather hours, situations
    labels   -> model predictions
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timepoint.functions.columns import computed_once
from timepoint.functions.geo import in_bbox
from timepoint.operators import disruptions, equity, headway, matching, reliability, spatial
from timepoint.settings import Settings
from timepoint.sources import gtfs, situations, weather
from timepoint.sources.storage import stored

STUDY = dataclasses.replace(
    Settings(),
    study_dates=tuple(dt.date(2024, 1, d) for d in range(1, 8)),
    region_stop_prefix="S",
)

# Fixed values of the binding, shared with the SQL prelude.
AREA_X0, AREA_W = -2.2507, 0.00105
AREA_Y0, AREA_H = 53.531, 0.000467
METRES_PER_DEGREE = 111195
STUDY_EPOCH = 1_704_067_200  # 2024-01-01T00:00:00Z


# A cell of the 1000 x 1000 grid holds one area of every further million, side by side in
# slices 1/2, 1/6, 1/12, ... of its width, so areas never overlap however many there are.
AREA_LAYER = "(({area}) div 1000000)"
AREA_WIDTH = f"{AREA_W}D / (({AREA_LAYER} + 1) * ({AREA_LAYER} + 2))"
AREA_WEST = (
    f"{AREA_X0}D + (({{area}}) * 367 % 1000) * {AREA_W}D"
    f" + {AREA_W}D * {AREA_LAYER} / ({AREA_LAYER} + 1)"
)
AREA_SOUTH = f"{AREA_Y0}D + ((({{area}}) * 613 + ({{area}}) div 1000) % 1000) * {AREA_H}D"
STOP_LON = f"{AREA_WEST} + (({{k}}) * 37 % 113) / 100D * ({AREA_WIDTH})"
STOP_LAT = f"{AREA_SOUTH} + (({{k}}) * 53 % 109) / 100D * {AREA_H}D"
ROUTE_OF_ORDER = (
    "case when {k} % 3 = 0 then {k} div 150 - ({k} div 150) % 4 else {k} div 150 end"
)

_schemas: dict[str, T.StructType] = {}


def with_stop_place(df: DataFrame, k: str) -> DataFrame:
    """Add stop_lat and stop_lon of the stop numbered by column ``k``."""
    area = f"{k} * 3 div 4"
    return computed_once(
        df,
        stop_lat=STOP_LAT.format(area=area, k=k),
        stop_lon=STOP_LON.format(area=area, k=k),
    )


class Tables:
    """Lazy transit tables over one directory of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = STUDY) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.settings = settings

    def raw(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _schemas:  # read each footer once per session, not once per query
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def pin(self, *names: str) -> None:
        """Compute tables now that a query uses several times, and keep them for it."""
        for name in names:
            setattr(self, name, stored(getattr(self, name)))

    # ---------------------------------------------------------------- timetable
    @cached_property
    def stops_raw(self) -> DataFrame:
        parts = with_stop_place(self.raw("part").select("p_partkey"), "p_partkey")
        place = ("stop_lat", "stop_lon")
        first = parts.selectExpr(
            "'S' || p_partkey as stop_id", "'Stop ' || p_partkey as stop_name", *place
        )
        again = first.filter("cast(substr(stop_id, 2) as long) % 3 = 0").selectExpr(
            "stop_id", "stop_name || ' bis' as stop_name", *place
        )
        return first.unionByName(again)

    @cached_property
    def stops(self) -> DataFrame:
        return gtfs.stops_in_region(self.stops_raw, self.settings.box)

    @cached_property
    def routes_raw(self) -> DataFrame:
        route = self.raw("supplier").selectExpr(
            "'R' || s_suppkey as route_id",
            "'OP' || (s_nationkey % 7) as agency_id",
            "'Line ' || (s_suppkey + 100) as route_short_name",
        )
        return route.unionByName(route.filter("substr(route_id, -1) = '5'"))

    @cached_property
    def routes(self) -> DataFrame:
        return gtfs.routes_dedup(self.routes_raw)

    @cached_property
    def trips_raw(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "'T' || o_orderkey as trip_id",
            f"'R' || ({ROUTE_OF_ORDER.format(k='o_orderkey')}) as route_id",
            "o_orderkey div 150 as service_id",
        )

    def _lines(self, lines: DataFrame | None = None) -> DataFrame:
        """lineitem with route number, stop number and scheduled second."""
        lines = self.raw("lineitem") if lines is None else lines
        numbered = computed_once(lines, rn=ROUTE_OF_ORDER.format(k="l_orderkey"))
        return numbered.selectExpr(
            "*",
            "rn * 20 + (l_partkey + l_linenumber) % 25 as k",
            "18000 + (l_orderkey * 37 % 1150) * 60 + l_linenumber * 240 as sched_sec",
        )

    @cached_property
    def stop_times_raw(self) -> DataFrame:
        def two(x: str) -> str:
            return f"lpad(cast({x} as string), 2, '0')"

        clock = (two("sched_sec div 3600"), two("sched_sec % 3600 div 60"), two("sched_sec % 60"))
        timed = computed_once(self._lines(), arrival_time=f"concat_ws(':', {', '.join(clock)})")
        return timed.selectExpr(
            "'T' || l_orderkey as trip_id",
            "'S' || k as stop_id",
            "l_linenumber as stop_sequence",
            "arrival_time",
        )

    @cached_property
    def stop_times(self) -> DataFrame:
        return gtfs.stop_times_in_region(self.stop_times_raw, self.stops)

    @cached_property
    def trips(self) -> DataFrame:
        return gtfs.trips_touching_region(self.trips_raw, self.stop_times)

    @cached_property
    def calendar(self) -> DataFrame:
        flags = (
            f"cast((s_suppkey + {day}) % 3 <> 0 as int) as {name}"
            for day, name in enumerate(gtfs.WEEKDAYS)
        )
        return self.raw("supplier").selectExpr(
            "s_suppkey as service_id",
            *flags,
            "20231201 as start_date",
            "case when s_suppkey % 9 = 8 then 20240103 else 20241231 end as end_date",
        )

    # ---------------------------------------------------------------- vehicle pings
    def pings_of(self, lines: DataFrame) -> DataFrame:
        """All reported pings of the given lineitem rows (batch or stream)."""
        placed = with_stop_place(self._lines(lines), "k").selectExpr(
            "*", "(l_orderkey + cast(l_linenumber = 7 as int)) % 7 as day"
        )
        timed = computed_once(
            placed,
            ts=f"{STUDY_EPOCH} + day * 86400 + sched_sec + (cast(l_quantity as int) - 20) * 5 "
            "+ (rn % 5) * 20 + if(l_tax = 0.08D and l_discount = 0.1D, 7200, 0)",
            lat=f"stop_lat + (l_partkey * 13 % 70) / {METRES_PER_DEGREE}D",
        )
        return timed.selectExpr(
            "'V' || l_suppkey as vehicle_id",
            "if(l_partkey % 10 <> 0, 'T' || l_orderkey, null) as trip_id",
            "'R' || rn as route_id",
            "lat",
            "stop_lon as lon",
            "if(l_partkey % 4 <> 0, cast(l_partkey % 360 as double), null) as bearing",
            "ts",
            "timestamp_seconds(ts) as ts_utc",
            "date_add(date '2024-01-01', cast(day as int)) as service_date",
            "ts div 60 as snapshot_id",
        )

    @cached_property
    def pings_all(self) -> DataFrame:
        return self.pings_of(self.raw("lineitem"))

    @cached_property
    def positions(self) -> DataFrame:
        return self.pings_all.filter(
            in_bbox(F.col("lat"), F.col("lon"), self.settings.box)
        ).drop("snapshot_id")

    @cached_property
    def pings_repeated(self) -> DataFrame:
        """Every report, plus a third of them seen again by the next poll."""
        lines = self.raw("lineitem")
        again = self.pings_of(lines.filter("l_partkey % 3 = 0"))
        return self.pings_all.unionByName(
            again.withColumn("snapshot_id", F.col("snapshot_id") + 1)
        )

    # ---------------------------------------------------------------- surroundings
    @cached_property
    def weather(self) -> DataFrame:
        return weather.weather_hourly(self.weather_documents)

    @cached_property
    def weather_documents(self) -> DataFrame:
        """One JSON document of parallel hourly arrays per day."""
        hourly = (
            self.raw("events")
            .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at"))
            .agg(F.max("event_id").alias("m"))
        )
        rain = F.when(F.hour("at") % 3 == 0, 0.0).otherwise((F.col("m") * 7) % 25 / F.lit(10.0))
        row = F.struct(
            F.date_format("at", "yyyy-MM-dd'T'HH:mm").alias("time"),
            rain.alias("precipitation"),
            ((F.col("m") * 11) % 120 / F.lit(10.0)).alias("temperature_2m"),
            ((F.col("m") * 5) % 300 / F.lit(10.0)).alias("wind_speed_10m"),
        )
        days = hourly.groupBy(F.to_date("at").alias("day")).agg(
            F.array_sort(F.collect_list(row)).alias("rows")  # at most 24 per day
        )
        hours = F.struct(
            *(F.col(f"rows.{c}").alias(c) for c in weather.HOURLY_FIELDS)
        )
        return days.select(F.to_json(F.struct(hours.alias("hourly"))).alias("document"))

    @cached_property
    def areas_raw(self) -> DataFrame:
        """Rectangular areas as polygon rings; one in seven lies far from its stops."""
        placed = computed_once(
            self.raw("customer").select("c_custkey"),
            x=AREA_WEST.format(area="c_custkey"),
            y=AREA_SOUTH.format(area="c_custkey")
            + " - case when c_custkey % 7 = 3 then 5D else 0D end",
            width=AREA_WIDTH.format(area="c_custkey"),
        )

        def corner(x: str, y: str) -> str:
            return f"named_struct('x', {x}, 'y', {y})"

        east, north = "x + width", f"y + {AREA_H}D"
        corners = (("x", "y"), (east, "y"), (east, north), ("x", north), ("x", "y"))
        ring = ", ".join(corner(*c) for c in corners)
        return placed.selectExpr("'E' || c_custkey as lsoa_code", f"array(array({ring})) as rings")

    @cached_property
    def areas(self) -> DataFrame:
        return spatial.polygons_in_bbox(self.areas_raw, self.settings.box)

    @cached_property
    def deprivation(self) -> DataFrame:
        # one in seventeen is filed under a code that no area has
        return self.raw("customer").selectExpr(
            "case when c_custkey % 17 = 5 then 'N' else 'E' end || c_custkey as lsoa_code",
            "cast(1 + ((c_custkey div 15) * 3 + (c_custkey % 15) div 5) % 10 as int) as imd_decile",
            "(c_custkey * 13 % 800) / 10D as imd_score",
        )

    # ---------------------------------------------------------------- disruptions
    @cached_property
    def situation_documents(self) -> DataFrame:
        """One XML situation element per notice and snapshot."""
        e = F.col("event_id")
        day = F.to_date("ts")

        def tag(name: str, value: Column, present: Column | None = None) -> Column:
            text = F.concat(F.lit(f"<{name}>"), value.cast("string"), F.lit(f"</{name}>"))
            return text if present is None else F.when(present, text).otherwise("")

        def stop(value: Column) -> Column:
            return tag("AffectedStopPoint", tag("StopPointRef", value))

        first = F.expr("event_id div 5")
        own = F.concat(
            stop(F.concat(F.lit("S"), first)), stop(F.concat(F.lit("S"), first + 11))
        )
        foreign = stop(F.concat(F.lit("X"), "user_id"))
        points = F.when(e % 4 == 0, "").when(e % 4 == 1, foreign).otherwise(own)
        reason = F.col("event_type")
        period = F.concat(
            tag("StartTime", F.concat(day.cast("string"), F.lit("T00:00:00Z")), e % 11 != 0),
            tag(
                "EndTime",
                F.concat(
                    F.date_add(day, (e % 4).cast("int")).cast("string"), F.lit("T23:00:00Z")
                ),
                e % 5 != 0,
            ),
        )
        affects = F.concat(
            tag("StopPoints", points),
            tag(
                "Networks",
                tag("AffectedNetwork", tag("AffectedLine", tag("LineRef", F.concat(F.lit("L"), e % 13)))),
            ),
            tag("Operators", tag("AffectedOperator", tag("OperatorRef", F.concat(F.lit("OP"), e % 7)))),
        )
        body = F.concat(
            F.lit('<PtSituationElement xmlns="http://www.siri.org.uk/siri">'),
            tag("SituationNumber", F.concat(F.lit("SIT"), F.expr("event_id div 12"))),
            tag("ParticipantRef", F.concat(F.lit("P"), F.col("user_id") % 7)),
            tag("Progress", F.when(e % 3 == 0, "closed").otherwise("open")),
            tag("MiscellaneousReason", reason, e % 3 != 0),
            tag("EquipmentReason", reason, e % 3 == 0),
            tag("Planned", F.when(e % 2 == 0, "true").otherwise("false")),
            tag("Summary", F.concat(F.lit("Notice "), "event_id")),
            tag("ValidityPeriod", period),
            tag("Consequences", tag("Consequence", tag("Affects", affects))),
            F.lit("</PtSituationElement>"),
        )
        # documents are dear to decode and events are narrow: dealt over the session's partitions
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return (
            self.raw("events")
            .select("event_id", "event_type", "user_id", "ts")
            .repartition(tasks, "event_id")
            .select(
                body.alias("element"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("fetched_at"),
                e.alias("snapshot_id"),
            )
        )

    @cached_property
    def situations_decoded(self) -> DataFrame:
        return situations.decode_situations(self.situation_documents)

    @cached_property
    def situation_snapshots(self) -> DataFrame:
        return situations.filter_situations_region(
            self.situations_decoded, self.settings.region_stop_prefix
        )

    @cached_property
    def situations_latest(self) -> DataFrame:
        return situations.latest_situation(self.situation_snapshots)

    # ---------------------------------------------------------------- derived facts
    @cached_property
    def delays(self) -> DataFrame:
        return matching.trip_stop_delay(
            self.positions, self.stop_times, self.stops, self.settings
        )

    @cached_property
    def trip_facts(self) -> DataFrame:
        return reliability.trip_rollup(self.delays, self.settings)

    @cached_property
    def band_days(self) -> DataFrame:
        return reliability.route_band_day(self.trip_facts, self.settings)

    @cached_property
    def stop_areas(self) -> DataFrame:
        located = spatial.point_in_polygon(self.stops, self.areas)
        return equity.area_attributes(located, self.deprivation)

    @cached_property
    def stop_routes(self) -> DataFrame:
        # the bridge keeps trips with a stop in the region by itself
        return disruptions.stop_route_bridge(self.stop_times, gtfs.trips_dedup(self.trips_raw))

    @cached_property
    def route_areas(self) -> DataFrame:
        return equity.route_deprivation(self.stop_routes, self.stop_areas)

    @cached_property
    def sched_headways(self) -> DataFrame:
        trips = gtfs.trips_dedup(self.trips_raw)
        return headway.headway_scheduled(self.stop_times, trips, self.settings)

    @cached_property
    def obs_headways(self) -> DataFrame:
        return headway.headway_observed(self.delays, self.sched_headways, self.settings)

    @cached_property
    def predictions(self) -> DataFrame:
        """Scores of three models on the labelled documents."""
        scored = self.raw("labels").selectExpr(
            "doc_id", "quality", "explode(array(1, 2, 3)) as m"
        )
        scored = computed_once(
            scored,
            score="round(0.35D * quality + 0.65D * ((doc_id * 7919 * m) % 1000 / 1000D), 3)",
        )
        return scored.selectExpr(
            "'model_' || m as model",
            "doc_id as case_id",
            "quality as label",
            "score",
            "cast(score >= 0.5D as int) as prediction",
        )
