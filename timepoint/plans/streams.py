"""Queries that run a stream over the given tables and return what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.plans import landing
from timepoint.plans.binding import Tables
from timepoint.plans.oracle import IN_BOX
from timepoint.plans.registry import query
from timepoint.streaming import positions
from timepoint.sources.parts import Parts, bucket_of, upsert_batch
from timepoint.sources.positions import dedup_pings
from timepoint.sources.situations import latest_situation
from timepoint.streaming.positions import generation, latest_generation
from timepoint.streaming.situations import stream_situations


def _stream(t: Tables) -> DataFrame:
    return t.pings_of(positions.stream_table(t.spark, t.sf_dir, "lineitem"))


def _repeated_stream(t: Tables) -> DataFrame:
    lines = positions.stream_table(t.spark, t.sf_dir, "lineitem")
    return t.pings_of(lines).unionByName(t.pings_of(lines.filter("l_partkey % 3 = 0")))


def _run(t: Tables, stream: DataFrame) -> DataFrame:
    return positions.run_available(
        stream, positions.new_folder(t.spark, "sink"), positions.new_folder(t.spark, "progress")
    )


@query(
    "stream_positions",
    """select service_date, count(*) as pings, count(trip_id) as with_trip
       from pings_all group by service_date""",
)
def _(t: Tables) -> DataFrame:
    landed = _run(t, _stream(t))
    return landed.groupBy("service_date").agg(
        F.count(F.lit(1)).alias("pings"), F.count("trip_id").alias("with_trip")
    )


#: Polls in ten minutes by a thousand vehicles, which bounds a snapshot's size.
_POLL = "service_date || '/' || (snapshot_id {div} 10) || '-' || (cast(substr(vehicle_id, 2) as bigint) {div} 1000)"
_BATCHES = 4


def _landed_snapshots(t: Tables) -> tuple[str, int]:
    """All reports as snapshot files, and a cut-off copy of some; their folder and number."""
    named = t.pings_repeated.withColumn("source", F.expr(_POLL.format(div="div")))
    whole = landing.encode_snapshots(named)
    cut = F.expr("substring(content, 1, length(content) - 3)")
    copies = F.when(F.col("source").rlike("3-[0-9]+$"), F.array(F.lit(""), F.lit("-cut"))).otherwise(F.array(F.lit("")))
    files = whole.select("source", "content", F.explode(copies).alias("mark")).select(
        F.concat("source", "mark").alias("source"),
        F.when(F.col("mark") == "", F.col("content")).otherwise(cut).alias("content"),
    )
    folder = positions.new_folder(t.spark, "snapshots")
    return folder, landing.land_files(files, folder, ".pb")


def _ingested(t: Tables) -> str:
    folder, n = _landed_snapshots(t)
    table = positions.new_folder(t.spark, "pings")
    decoded = positions.stream_snapshots(t.spark, folder, files_per_batch=max(1, -(-n // _BATCHES)))
    positions.ingest_snapshots(decoded, table, positions.new_folder(t.spark, "progress"))
    return table


@query(
    "stream_snapshots",
    """with seen as (
            select vehicle_id, ts, trip_id, route_id, cast(cast(lat as float) as double) as lat,
                   cast(cast(lon as float) as double) as lon, bearing from pings_repeated)
       select * exclude (place) from (
            select *, row_number() over (partition by vehicle_id, ts order by trip_id nulls last,
                      route_id, lat, lon, bearing nulls first) as place from seen)
       where place = 1""",
    "lat lon bearing",
)
def _(t: Tables) -> DataFrame:
    pings = positions.ingested_pings(t.spark, _ingested(t)).drop("source", "ts_utc")
    return dedup_pings(pings).drop("ts_utc")


@query(
    "stream_snapshot_quarantine",
    f"""select distinct source || '-cut' as source, 'corrupt' as status
        from (select {_POLL.format(div="//")} as source from pings_repeated)
        where regexp_matches(source, '3-[0-9]+$')""",
)
def _(t: Tables) -> DataFrame:
    bad = positions.ingested_quarantine(t.spark, _ingested(t))
    return bad.select(F.regexp_extract("source", r"([^/]+/[^/]+)\.pb$", 1).alias("source"), "status")


def _landed_reports(t: Tables, order: list[str]) -> DataFrame:
    """All reports, landed in several sets of files that keep no order of time, as a stream."""
    folder = positions.new_folder(t.spark, "landed")
    files = t.spark.sparkContext.defaultParallelism
    for which in order:
        t.pings_repeated.filter(which).repartition(files).write.mode("append").parquet(folder)
    return (
        t.spark.readStream.schema(t.pings_repeated.schema)
        .option("maxFilesPerTrigger", files)
        .parquet(folder)
    )


_SETS = ["pmod(ts, 3) = 2 and service_date > '2024-01-02'", "pmod(ts, 3) = 0", "pmod(ts, 3) = 1",
         "pmod(ts, 3) = 2 and service_date <= '2024-01-02'"]


@query(
    "stream_dedup_pings",
    """select vehicle_id, ts, trip_id, route_id, lat, lon, bearing, service_date, snapshot_id
       from (select *, row_number() over (
                 partition by vehicle_id, ts
                 order by trip_id nulls last, snapshot_id, route_id, lat, lon,
                          bearing nulls first, service_date) as place
             from pings_repeated) where place = 1""",
    "lat lon bearing",
)
def _(t: Tables) -> DataFrame:
    stream = _landed_reports(t, _SETS)
    table = positions.new_folder(t.spark, "deduped")
    positions.run_dedup(stream, table, positions.new_folder(t.spark, "progress"))
    schema = stream.drop("ts_utc").schema
    return positions.deduped_pings(t.spark, table, schema).drop("ts_utc")


@query(
    "stream_quality",
    f"""with reports as (
            select service_date, vehicle_id, ts, count(*) filter ({IN_BOX}) as n,
                   count(*) filter (not ({IN_BOX})) as out,
                   max(cast({IN_BOX} and trip_id is not null as int)) as named
            from pings_repeated group by 1, 2, 3)
        select service_date, cast(sum(n) as bigint) as raw_pings,
               count(*) filter (n > 0) as deduped_pings, cast(sum(out) as bigint) as out_of_bbox,
               cast(sum(named) as bigint) as with_trip_id,
               round(1e0 - count(*) filter (n > 0) / sum(n), 4) as duplicate_share,
               round(sum(named) / count(*) filter (n > 0), 4) as trip_id_share
        from reports group by 1""",
    "duplicate_share trip_id_share",
)
def _(t: Tables) -> DataFrame:
    return positions.stream_quality(
        _landed_reports(t, _SETS),
        t.settings.box,
        positions.new_folder(t.spark, "reports"),
        positions.new_folder(t.spark, "progress"),
    )


def _landed_notices(t: Tables, sets: int) -> DataFrame:
    """The notices, decoded once and landed in sets by their snapshot; ``arrival`` numbers the set."""
    notices = t.situation_snapshots.withColumn("arrival", F.col("snapshot_id") % sets)
    folder = positions.new_folder(t.spark, "notices")
    notices.write.partitionBy("arrival").parquet(folder)
    return t.spark.read.schema(notices.schema).parquet(folder)


#: Batches of the upsert query, and buckets of keys of the tables it and the notices write here.
_UPSERTS, _BUCKETS = 10, 16


@query(
    "upsert_batches",
    f"""with notices as (
            select situation_id, snapshot_id % {_UPSERTS} as batch,
                   cast('0x' || substr(md5(situation_id), 1, 8) as bigint) % {_BUCKETS} as bucket
            from situation_snapshots),
        starts as (select bucket, situation_id, min(batch) as first from notices group by all),
        touched as (select distinct batch, bucket from notices)
        select cast(t.batch as int) as batch, count(distinct t.bucket) as buckets_touched,
               count(*) as rows_written
        from touched t join starts s on s.bucket = t.bucket and s.first <= t.batch
        group by t.batch""",
)
def _(t: Tables) -> DataFrame:
    table = Parts(t.spark, positions.new_folder(t.spark, "latest"))
    notices = _landed_notices(t, _UPSERTS)
    written = []
    for batch in range(_UPSERTS):
        arriving = notices.filter(F.col("arrival") == batch).drop("arrival")
        report = upsert_batch(table, arriving, batch, ["situation_id"], latest_situation, _BUCKETS)
        rows = table.read([f"{table.path}/rows={batch:09d}"], arriving.schema) if report["buckets_touched"] else arriving
        counted = rows.agg(
            F.lit(batch).alias("batch"),
            F.count_distinct(bucket_of(["situation_id"], _BUCKETS)).alias("buckets_touched"),
            F.count(F.lit(1)).alias("rows_written"),
        ).filter("rows_written > 0")
        written.append(counted.first())
    kinds = "batch int, buckets_touched bigint, rows_written bigint"
    return t.spark.createDataFrame([tuple(r) for r in written if r is not None], kinds)


@query(
    "stream_daily_counters",
    f"""select ts // 86400 as epoch_day,
               count(*) filter ({IN_BOX}) as raw_pings,
               count(*) filter (not ({IN_BOX})) as out_of_bbox,
               count(*) filter ({IN_BOX} and trip_id is not null) as raw_with_trip_id
        from pings_repeated group by 1""",
)
def _(t: Tables) -> DataFrame:
    counters = positions.daily_counters(_repeated_stream(t), t.settings.box)
    sink = positions.new_folder(t.spark, "counters")

    # a generation per batch: a repeated batch replaces its own, and never the one being read
    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(generation(sink, batch))

    positions.run_batches(
        counters, keep, positions.new_folder(t.spark, "progress"), mode="complete"
    )
    return latest_generation(t.spark, sink)


@query(
    "stream_situations",
    "select situation_id, summary, fetched_at from situations_latest",
)
def _(t: Tables) -> DataFrame:
    landed = positions.new_folder(t.spark, "landed")
    # three fetches, each its own set of files, consumed a set per micro-batch
    files = t.spark.sparkContext.defaultParallelism
    notices = _landed_notices(t, 3)
    for third in range(3):
        fetched = notices.filter(F.col("arrival") == third).drop("arrival")
        fetched.repartition(files).write.mode("append").parquet(landed)
    snapshots = (
        t.spark.readStream.schema(t.situation_snapshots.schema)
        .option("maxFilesPerTrigger", files)
        .parquet(landed)
    )
    latest, _ = stream_situations(
        snapshots,
        positions.new_folder(t.spark, "latest"),
        positions.new_folder(t.spark, "progress"),
        _BUCKETS,
    )
    return latest.select("situation_id", "summary", "fetched_at")
