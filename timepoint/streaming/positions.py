"""Continuous ingestion of vehicle positions.

Landed snapshot files are decoded in the stream, with a side output of those that cannot be
read. Reports are de-duplicated by state that expires in event time, and daily quality is kept
as mergeable counts whose closed days are settled. ``run_available`` and ``run_batches`` drive
a query over everything landed so far and stop, which is how a scheduled job calls it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from timepoint.functions.geo import in_bbox
from timepoint.settings import Box
from timepoint.sources.parts import Parts, folders_of
from timepoint.sources.positions import (
    decode_position_snapshots,
    decoded_pings,
    dedup_pings,
    quality_of_reports,
    report_counts,
)
from timepoint.sources.storage import matching_paths, shared_directory

# ---------------------------------------------------------------- snapshots


_LOOKUP_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def stream_snapshots(
    spark: SparkSession, path: str, glob: str = "*.pb", files_per_batch: int | None = None
) -> DataFrame:
    """Landed protobuf snapshots, decoded as they arrive; unreadable ones say so in ``status``."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(path).select(F.col("path").alias("source"), "content")
    return decode_position_snapshots(files)


def ingest_snapshots(decoded: DataFrame, table: str, checkpoint: str) -> None:
    """Keep all available snapshots: pings and the quarantine, each micro-batch decoded once.

    A batch is written under its number, split by status, so one that is repeated after a
    failure replaces itself and a reader of pings never opens the quarantine. Spark looks up a
    batch's files in a task each, up to 10,000; they are shared by a few tasks per core instead.
    """
    spark = decoded.sparkSession
    before = spark.conf.get(_LOOKUP_TASKS)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("status").parquet(f"{table}/batch={number}")

    spark.conf.set(_LOOKUP_TASKS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        run_batches(decoded, keep, checkpoint)
    finally:
        spark.conf.set(_LOOKUP_TASKS, before)


def _ingested(spark: SparkSession, table: str) -> DataFrame:
    from timepoint.sources.positions import DECODED

    return spark.read.schema(f"{DECODED}, batch int").option("basePath", table).parquet(f"{table}/batch=*")


def ingested_pings(spark: SparkSession, table: str) -> DataFrame:
    """The pings of all snapshots that could be read."""
    return decoded_pings(_ingested(spark, table).drop("batch"))


def ingested_quarantine(spark: SparkSession, table: str) -> DataFrame:
    """The snapshots that could not be read, with the batch that met them."""
    return _ingested(spark, table).filter(F.col("status") == "corrupt").select("source", "status", "batch")


def stream_table(
    spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None
) -> DataFrame:
    """A landed Parquet table as a stream of its files, all at once or so many a batch."""
    pattern = f"{name}.parquet"
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


# ---------------------------------------------------------------- de-duplication

#: Reports of one vehicle are spread over so many keys, by their second.
LANES = 16
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class BestReports(StatefulProcessor):
    """The best row per report time of one key, as long as the key's clock is near it.

    The clock is the latest report time the key has seen. A row that improves on what is known
    is passed on; one older than ``keep`` seconds before the clock is passed on as late, as
    nothing is known of its time any more. State older than that is forgotten. State is written
    where it changed only; rows are few per key and batch, so they come one by one, not as frames.
    """

    def __init__(self, schema: T.StructType, keep: int) -> None:
        self.schema, self.keep = schema, keep
        self.names = schema.fieldNames()
        self.ts, self.trip = self.names.index("ts"), self.names.index("trip_id")
        self.seen = self.names.index("snapshot_id") if "snapshot_id" in self.names else None
        self.out = Row(*self.names, "late")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getListState("best", self.schema)
        self.clock = handle.getValueState("clock", "ts long")

    def _order(self, row: tuple) -> tuple:
        """As ``dedup_pings`` orders the rows of one report: named trips, polls, then the rest."""
        trip = row[self.trip]
        seen = () if self.seen is None else (row[self.seen] is not None, row[self.seen] or 0)
        rest = tuple((v is not None, v if v is not None else 0) for v in row)
        return (trip is None, trip or "", *seen, *(x for pair in rest for x in pair))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        before = self.clock.get()[0] if self.clock.exists() else None
        # a key without a clock has no state yet
        known = {} if before is None else {row[self.ts]: row for row in map(tuple, self.best.get())}
        latest = before
        forgotten = None if before is None else before - self.keep
        fresh: dict[int, tuple] = {}
        for row in rows:
            # a number that is none is kept as NULL, so that rows of a report have an order
            row = tuple(None if v != v else v for v in (row[name] for name in self.names))
            ts = row[self.ts]
            if ts is None:  # no place in time, so no state: the reader keeps the best of them
                yield self.out(*row, False)
                continue
            latest = ts if latest is None else max(latest, ts)
            if forgotten is not None and ts < forgotten:
                yield self.out(*row, True)
                continue
            other = fresh.get(ts) or known.get(ts)
            if other is None or self._order(row) < self._order(other):
                fresh[ts] = row
        for row in fresh.values():
            yield self.out(*row, False)
        kept = [row for ts, row in (known | fresh).items() if ts >= latest - self.keep]
        if fresh or len(kept) < len(known):
            if kept:
                self.best.put(kept)
            else:
                self.best.clear()
        if latest != before:
            self.clock.update((latest,))

    def close(self) -> None:
        pass


def stream_dedup_pings(pings: DataFrame, keep: dt.timedelta = dt.timedelta(days=2)) -> DataFrame:
    """Rows of ``pings`` that improve on what their report's state holds, and late ones, flagged.

    State runs in event time: each (vehicle, lane of seconds) keeps the reports of the last
    ``keep`` before its own latest one, whenever files arrive. ``dedup_pings`` of everything
    passed on is ``dedup_pings`` of everything that arrived, in any order of files: the best row
    of a report always passes, on time or late. A vehicle that reports very often is spread over
    ``LANES`` keys; one that stops keeps its last horizon. Wants the RocksDB state store
    (``with_state_store``). Columns: those of ``pings`` but ts_utc, and late.
    """
    rows = pings.drop("ts_utc")
    schema = rows.schema
    names = {f.name for f in schema}
    if not {"vehicle_id", "ts", "trip_id"} <= names:
        raise ValueError("pings need vehicle_id, ts and trip_id")
    lane = F.pmod("ts", F.lit(LANES)).alias("_lane")
    plain = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    return (
        rows.withColumn("_lane", lane)
        .groupBy("vehicle_id", "_lane")
        .transformWithState(
            BestReports(plain, int(keep.total_seconds())),
            outputStructType=T.StructType([*plain.fields, T.StructField("late", T.BooleanType())]),
            outputMode="append",
            timeMode="none",
        )
    )


def run_dedup(
    pings: DataFrame, table: str, checkpoint: str, keep: dt.timedelta = dt.timedelta(days=2)
) -> list[dict]:
    """De-duplicate everything available into ``table``; per micro-batch what state it kept.

    Late rows lie apart from the others. ``deduped_pings`` reads the result.
    """
    spark = pings.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, STATE_PROVIDER)

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("late").parquet(f"{table}/batch={number}")

    try:
        query = _started(stream_dedup_pings(pings, keep).writeStream.foreachBatch(save), checkpoint)
        query.awaitTermination()
        return [
            {
                "batch": p.batchId,
                "rows": p.numInputRows,
                "state_rows": sum(o.numRowsTotal for o in p.stateOperators),
                "state_bytes": sum(o.memoryUsedBytes for o in p.stateOperators),
            }
            for p in query.recentProgress
            if p.numInputRows
        ]
    finally:
        spark.conf.set(setting, before)


def passed_on(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Everything the de-duplication passed on, with ``late`` and ``batch``."""
    whole = T.StructType([*schema.fields, T.StructField("late", T.BooleanType()), T.StructField("batch", T.IntegerType())])
    if not matching_paths(spark, f"{table}/batch=*"):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", table).parquet(f"{table}/batch=*")


def deduped_pings(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """One row per (vehicle, report time) of everything streamed so far, late rows included."""
    return dedup_pings(passed_on(spark, table, schema).drop("late", "batch"))


# ---------------------------------------------------------------- quality

#: Folders of an open day before they are merged into one, and days a day stays open.
MOST_FOLDERS, OPEN_DAYS = 8, 2
_REPORT = T.StructType(
    [
        T.StructField("service_date", T.DateType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("inside", T.LongType()),
        T.StructField("outside", T.LongType()),
        T.StructField("named", T.IntegerType()),
    ]
)
_COUNTERS = ("raw_pings", "deduped_pings", "out_of_bbox", "with_trip_id", "duplicate_share", "trip_id_share")


def _merged_reports(reports: DataFrame) -> DataFrame:
    return reports.groupBy("service_date", "vehicle_id", "ts").agg(
        F.sum("inside").alias("inside"),
        F.sum("outside").alias("outside"),
        F.max("named").alias("named"),
    )


class QualityTable:
    """Quality counters per service date, kept as mergeable counts of reports.

    A micro-batch adds a folder of counts to each day it has reports of; a day with more than
    ``MOST_FOLDERS`` is merged into one. A day that lies ``OPEN_DAYS`` behind the latest one is
    closed: its counts are merged, its counters settled in the commit, and nobody reads its
    folder again, unless a late report reopens it, which only that day pays for.
    """

    def __init__(self, spark: SparkSession, path: str, open_days: int = OPEN_DAYS) -> None:
        self.parts, self.open_days = Parts(spark, path), open_days

    def add(self, pings: DataFrame, box: Box, number: int) -> None:
        """Take one micro-batch in; a batch repeated after its commit changes nothing."""
        if number <= self.parts.number:
            return
        days = self.parts.current()
        dated = report_counts(pings, box).withColumn("_day", F.coalesce(F.col("service_date").cast("string"), F.lit("none")))
        for day, folder in self.parts.stage(dated, number, "counts", "_day").items():
            days[day] = {"folders": [*days.get(day, {"folders": []})["folders"], folder]}
        self.parts.commit(number, self._settled(days, number))

    def _settled(self, days: dict[str, dict], number: int) -> dict[str, dict]:
        """Days with few folders, and counters for those that are over."""
        dates = [dt.date.fromisoformat(d) for d in days if d != "none"]
        last = max(dates).toordinal() - self.open_days if dates else 0
        over = {d for d in days if d != "none" and dt.date.fromisoformat(d).toordinal() <= last}
        closing = {d for d in over if "note" not in days[d]}
        many = {d for d in days if len(days[d]["folders"]) > MOST_FOLDERS}
        chosen = sorted(closing | many)
        if not chosen:
            return days
        counts = self.parts.read([f for d in chosen for f in days[d]["folders"]], _REPORT)
        merged = _merged_reports(counts).withColumn("_day", F.coalesce(F.col("service_date").cast("string"), F.lit("none")))
        written = self.parts.stage(merged, number, "merged", "_day")
        for day in chosen:
            days[day] = {"folders": [written[day]]}
        if closing:
            settled = self.parts.read([written[d] for d in sorted(closing)], _REPORT)
            for row in quality_of_reports(settled).collect():  # one row per day that closes
                days[str(row.service_date)]["note"] = json.dumps({c: row[c] for c in _COUNTERS})
        return days

    def open_folders(self) -> list[str]:
        """The folders that a reading opens: of days that are not settled."""
        return folders_of({d: p for d, p in self.parts.current().items() if "note" not in p})

    def quality(self) -> DataFrame:
        """The counters of all days: settled ones from the commit, open ones from their counts."""
        spark = self.parts.spark
        now = quality_of_reports(self.parts.read(self.open_folders(), _REPORT))
        settled = [
            (dt.date.fromisoformat(d), *(json.loads(p["note"])[c] for c in _COUNTERS))
            for d, p in self.parts.current().items()
            if "note" in p
        ]
        kinds = {f.name: f.dataType for f in now.schema}
        schema = T.StructType([T.StructField(c, kinds[c]) for c in ("service_date", *_COUNTERS)])
        return now.select(*schema.fieldNames()).unionByName(spark.createDataFrame(settled, schema))


def stream_quality(
    pings: DataFrame, box: Box, table: str, checkpoint: str, open_days: int = OPEN_DAYS
) -> DataFrame:
    """Quality counters per service date over everything streamed so far."""
    kept = QualityTable(pings.sparkSession, table, open_days)
    run_batches(pings, lambda batch, number: kept.add(batch, box, number), checkpoint)
    return kept.quality()


def daily_counters(pings: DataFrame, box: Box, lateness: str = "2 days") -> DataFrame:
    """Running raw and out-of-box counters per day of report time."""
    inside = F.coalesce(in_bbox(F.col("lat"), F.col("lon"), box), F.lit(False))
    return (
        pings.withWatermark("ts_utc", lateness)
        .groupBy(F.window("ts_utc", "1 day").alias("day"))
        .agg(
            F.count_if(inside).alias("raw_pings"),
            F.count_if(~inside).alias("out_of_bbox"),
            F.count_if(inside & F.col("trip_id").isNotNull()).alias("raw_with_trip_id"),
        )
        .select(
            F.floor(F.unix_seconds("day.start") / 86_400).alias("epoch_day"),
            "raw_pings",
            "out_of_bbox",
            "raw_with_trip_id",
        )
    )


def generation(table: str, batch: int) -> str:
    """Folder of a result that every micro-batch writes whole."""
    return f"{table.rstrip('/')}/generation={batch:09d}"


def latest_generation(spark: SparkSession, table: str) -> DataFrame:
    written = matching_paths(spark, f"{table.rstrip('/')}/generation=*")
    if not written:
        raise ValueError(f"nothing was written to {table}")
    return spark.read.parquet(max(written))


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_directory(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def run_available(stream: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Append everything available to a Parquet sink and return the sink."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(sink)


def _started(writer, checkpoint: str):
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> None:
    """Hand every available micro-batch to ``handle``."""
    _started(stream.writeStream.foreachBatch(handle).outputMode(mode), checkpoint).awaitTermination()
