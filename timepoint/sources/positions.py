"""Vehicle-position snapshots: protobuf decoding, quarantine, de-duplication, quality."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from timepoint.functions.geo import in_bbox
from timepoint.operators.dedup import keep_first
from timepoint.settings import Box

# The fields read from the public realtime feed format, as
# (message, field, number, type, repeated). Types are protobuf scalar names or messages.
FEED_FIELDS = (
    ("FeedMessage", "header", 1, "FeedHeader", False),
    ("FeedMessage", "entity", 2, "FeedEntity", True),
    ("FeedHeader", "gtfs_realtime_version", 1, "string", False),
    ("FeedHeader", "timestamp", 3, "uint64", False),
    ("FeedEntity", "id", 1, "string", False),
    ("FeedEntity", "vehicle", 4, "VehiclePosition", False),
    ("VehiclePosition", "trip", 1, "TripDescriptor", False),
    ("VehiclePosition", "position", 2, "Position", False),
    ("VehiclePosition", "timestamp", 5, "uint64", False),
    ("VehiclePosition", "vehicle", 8, "VehicleDescriptor", False),
    ("TripDescriptor", "trip_id", 1, "string", False),
    ("TripDescriptor", "route_id", 5, "string", False),
    ("Position", "latitude", 1, "float", False),
    ("Position", "longitude", 2, "float", False),
    ("Position", "bearing", 3, "float", False),
    ("VehicleDescriptor", "id", 1, "string", False),
)

PING_COLUMNS = (
    "vehicle_id string, trip_id string, route_id string, lat double, lon double, "
    "bearing double, ts long"
)
DECODED = f"source string, status string, {PING_COLUMNS}"


@lru_cache(maxsize=1)
def feed_message_class():
    """FeedMessage class built at run time; needs only the ``protobuf`` package."""
    try:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    except ImportError as exc:  # pragma: no cover - depends on the environment
        raise RuntimeError("decoding snapshots needs the 'protobuf' package") from exc

    field = descriptor_pb2.FieldDescriptorProto
    scalars = {"string": field.TYPE_STRING, "uint64": field.TYPE_UINT64, "float": field.TYPE_FLOAT}
    file = descriptor_pb2.FileDescriptorProto(
        name="timepoint_feed.proto", package="timepoint", syntax="proto2"
    )
    messages: dict = {}
    for owner, name, number, kind, repeated in FEED_FIELDS:
        if owner not in messages:
            messages[owner] = file.message_type.add(name=owner)
        spec = messages[owner].field.add(
            name=name,
            number=number,
            label=field.LABEL_REPEATED if repeated else field.LABEL_OPTIONAL,
        )
        if kind in scalars:
            spec.type = scalars[kind]
        else:
            spec.type, spec.type_name = field.TYPE_MESSAGE, f".timepoint.{kind}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(
        pool.FindMessageTypeByName("timepoint.FeedMessage")
    )


def _decode(content: bytes) -> list[tuple]:
    feed = feed_message_class()()
    feed.ParseFromString(content)
    taken = feed.header.timestamp
    rows = []
    for e in feed.entity:
        if e.HasField("vehicle"):
            seen = e.vehicle  # each step into a message costs an object
            trip, place = seen.trip, seen.position
            rows.append(
                (
                    seen.vehicle.id or e.id,
                    trip.trip_id or None,
                    trip.route_id or None,
                    _number(place.latitude),
                    _number(place.longitude),
                    _number(place.bearing) if place.HasField("bearing") else None,
                    seen.timestamp or taken,
                )
            )
    return rows


def _number(value: float) -> float | None:
    return value if value == value else None  # NaN is no place


def _decode_batches(
    batches: Iterator[pa.RecordBatch], kinds: pa.Schema
) -> Iterator[pa.RecordBatch]:
    from google.protobuf.message import DecodeError

    nothing = (None,) * (len(kinds) - 2)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=kinds)

    for batch in batches:
        pending: list[tuple] = []
        for source, content in zip(batch.column("source"), batch.column("content"), strict=True):
            try:
                rows, status = _decode(content.as_py()), "ok"
            except (DecodeError, UnicodeDecodeError):  # quarantines its own file only
                rows, status = [], "corrupt"
            if not rows and status == "ok":
                status = "empty"
            head = (source.as_py(), status)
            pending += [(*head, *row) for row in rows or [nothing]]
            if len(pending) >= 5000:  # many small snapshots share a batch, large ones have theirs
                yield batch_of(pending)
                pending = []
        if pending:
            yield batch_of(pending)


def read_snapshots(spark: SparkSession, path: str, glob: str = "*.pb") -> DataFrame:
    """Landed snapshot files as (source, content), subdirectories included."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("path").alias("source"), "content")
    )


def decode_position_snapshots(snapshots: DataFrame) -> DataFrame:
    """One row per vehicle entity; a corrupt or empty snapshot gives one row saying so.

    Missing bearings, trip and route ids are NULL; the vehicle id falls back to the entity
    id and the time to the snapshot's own.
    """
    kinds = to_arrow_schema(T.StructType.fromDDL(DECODED))
    decoded = snapshots.select("source", "content").mapInArrow(
        lambda batches: _decode_batches(batches, kinds), DECODED
    )
    return decoded.withColumn("bearing", F.nanvl("bearing", F.lit(None).cast("double")))


def snapshot_status(decoded: DataFrame) -> DataFrame:
    """(source, status) per snapshot, from decoded rows."""
    return decoded.groupBy("source").agg(F.min("status").alias("status"))


def snapshot_quarantine(decoded: DataFrame) -> DataFrame:
    """Snapshots that could not be read."""
    return decoded.filter(F.col("status") == "corrupt").select("source", "status")


def decoded_pings(decoded: DataFrame) -> DataFrame:
    """Rows of readable snapshots that hold a ping, with the UTC instant."""
    return (
        decoded.filter(F.col("status") == "ok")
        .drop("status")
        .withColumn("ts_utc", F.timestamp_seconds("ts"))
    )


def pings_in_box(pings: DataFrame, box: Box) -> DataFrame:
    return pings.filter(in_bbox(F.col("lat"), F.col("lon"), box))


def dedup_pings(pings: DataFrame) -> DataFrame:
    """One row per (vehicle, report time): rows naming a trip win, then the earliest.

    The same report seen in successive snapshots is one observation.
    """
    seen = [F.col("snapshot_id")] if "snapshot_id" in pings.columns else []
    first = keep_first(
        pings, ["vehicle_id", "ts"], [F.col("trip_id").asc_nulls_last(), *seen]
    )
    return first.withColumn("ts_utc", F.timestamp_seconds("ts"))


def report_counts(pings: DataFrame, box: Box) -> DataFrame:
    """Sightings per (date, vehicle, report time), inside and outside the box.

    The counts of several batches may be stacked: :func:`quality_of_reports` merges them.
    """
    inside = F.coalesce(in_bbox(F.col("lat"), F.col("lon"), box), F.lit(False))
    return pings.groupBy("service_date", "vehicle_id", "ts").agg(
        F.count_if(inside).alias("inside"),
        F.count_if(~inside).alias("outside"),
        F.max((inside & F.col("trip_id").isNotNull()).cast("int")).alias("named"),
    )


def quality_of_reports(reports: DataFrame) -> DataFrame:
    """Per service date: pings, distinct reports, duplicate, out-of-box and trip shares."""
    merged = reports.groupBy("service_date", "vehicle_id", "ts").agg(
        F.sum("inside").alias("inside"),
        F.sum("outside").alias("outside"),
        F.max("named").alias("named"),
    )
    days = merged.groupBy("service_date").agg(
        F.sum("inside").alias("raw_pings"),
        F.count_if(F.col("inside") > 0).alias("deduped_pings"),
        F.sum("outside").alias("out_of_bbox"),
        F.sum("named").alias("with_trip_id"),
    )
    raw, kept, zero = F.col("raw_pings"), F.col("deduped_pings"), F.lit(0.0)
    return days.select(
        "*",
        F.coalesce(F.round(F.lit(1.0) - F.try_divide(kept, raw), 4), zero).alias("duplicate_share"),
        F.coalesce(F.round(F.try_divide("with_trip_id", kept), 4), zero).alias("trip_id_share"),
    )


def parse_quality_by_day(pings: DataFrame, box: Box, snapshots: DataFrame | None = None) -> DataFrame:
    """Per service date: snapshots read, pings, duplicates, out-of-box and trip shares.

    Repeats are counted per (date, vehicle, time) first, so a day with most of the pings is not
    gathered anywhere. Most reports are seen once: counting them before the exchange would hold
    all reports of an input split in one task's memory and make few rows of it, so they are
    exchanged first, into the session's number of parts, which are not made fewer again.
    """
    parts = int(pings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = pings.select("service_date", "vehicle_id", "ts", "lat", "lon", "trip_id").repartition(
        parts, "service_date", "vehicle_id", "ts"
    )
    quality = quality_of_reports(report_counts(apart, box))
    if snapshots is None:
        return quality
    files = snapshots.groupBy("service_date").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.count_if(F.col("status") == "corrupt").alias("corrupt_snapshots"),
    )
    return files.join(quality, "service_date", "left").fillna(0)


def count_raw_positions(decoded: DataFrame) -> DataFrame:
    """One row: snapshot files and the vehicle entities they hold, no region filter."""
    # a file's rows come from one task, so its count needs no exact distinct of paths
    return decoded.groupBy("source").agg(
        F.count("vehicle_id").alias("vehicles")
    ).agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.coalesce(F.sum("vehicles"), F.lit(0)).alias("vehicle_positions"),
    )
