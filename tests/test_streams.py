"""Streams over landed files: any split and order of files gives what the whole table gives."""

from __future__ import annotations

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from timepoint.plans import landing
from timepoint.settings import Settings
from timepoint.sources.parts import Parts, bucket_of, folders_of, upsert_batch
from timepoint.sources.positions import decode_position_snapshots, dedup_pings, parse_quality_by_day
from timepoint.streaming import positions, situations

PINGS = (
    "vehicle_id string, trip_id string, route_id string, lat double, lon double, bearing double, "
    "ts bigint, service_date date, snapshot_id bigint"
)
BOX = Settings().box
DAY = 86_400
EPOCH = 1_704_067_200  # a Monday


def some_pings(seed, n=400):
    """Reports of six days; one vehicle has a third of them, and polls repeat and rename some."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        vehicle = "hot" if rng.random() < 0.35 else f"V{rng.randrange(6)}"
        ts = EPOCH + rng.randrange(6 * DAY) // 900 * 900
        for poll in range(rng.randrange(1, 4)):
            trip = rng.choice([None, "T1", "T2"])
            lat = rng.choice([53.8, 10.0])
            rows.append((vehicle, trip, "R1", lat, -1.5, rng.choice([None, 90.0]), ts,
                         dt.date.fromordinal(dt.date(2024, 1, 1).toordinal() + (ts - EPOCH) // DAY), ts // 60 + poll))
    return rows


def land(spark, rows, schema, folder, files):
    """The rows as so many files, one after the other."""
    for k in range(files):
        part = rows[k::files]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)


def stream_of(spark, schema, folder):
    kind = spark.createDataFrame([], schema).schema
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(folder)


def new(tmp_path, label):
    return f"{tmp_path}/{label}-{uuid.uuid4().hex}"


def plain(df, *drop):
    return sorted((tuple(r) for r in df.drop("ts_utc", *drop).collect()), key=repr)


@pytest.mark.parametrize(("order", "files", "keep"), [("time", 3, 2), ("reverse", 3, 1), ("shuffled", 4, 0)])
def test_dedup_for_any_order_and_delay(spark, tmp_path, order, files, keep):
    rows = some_pings(order)
    by_time = sorted(rows, key=lambda r: r[6])
    rows = {"time": by_time, "reverse": by_time[::-1], "shuffled": rows}[order]
    # sets of neighbouring rows, so that whole days arrive late in reverse
    size = -(-len(rows) // files)
    sets = [rows[k : k + size] for k in range(0, len(rows), size)]
    folder, table, progress = (new(tmp_path, x) for x in ("in", "out", "progress"))
    for part in sets:
        land(spark, part, PINGS, folder, 1)
    kept = positions.run_dedup(stream_of(spark, PINGS, folder), table, progress, dt.timedelta(days=keep, hours=2))
    schema = spark.createDataFrame([], PINGS).schema
    got = positions.deduped_pings(spark, table, schema)
    assert plain(got) == plain(dedup_pings(spark.createDataFrame(rows, PINGS)))
    out = positions.passed_on(spark, table, schema)
    late = out.filter("late").count()
    assert (late > 0) == (order == "reverse" or order == "shuffled")
    # state holds the horizon and no more
    assert len(kept) == files and all(k["state_rows"] > 0 and k["state_bytes"] > 0 for k in kept)
    reports = len({(r[0], r[6]) for r in rows})
    if order == "time":
        assert kept[-1]["state_rows"] < reports


def test_dedup_goes_on_after_a_stop(spark, tmp_path):
    rows = some_pings(7, 150)
    folder, table, progress = (new(tmp_path, x) for x in ("in", "out", "progress"))
    schema = spark.createDataFrame([], PINGS).schema
    for _ in range(2):  # the second run meets the same reports again
        land(spark, rows, PINGS, folder, 1)
        positions.run_dedup(stream_of(spark, PINGS, folder), table, progress, dt.timedelta(days=9))
    assert plain(positions.deduped_pings(spark, table, schema)) == plain(dedup_pings(spark.createDataFrame(rows, PINGS)))
    # nothing improved on what the state held, so nothing was passed on twice
    assert positions.passed_on(spark, table, schema).filter("batch = 1").count() == 0


def test_snapshots_as_they_land(spark, tmp_path):
    rows = some_pings(3, 80)
    pings = spark.createDataFrame(rows, PINGS).withColumn("source", F.expr("'poll/' || (snapshot_id div 600)"))
    whole = landing.encode_snapshots(pings)
    folder = new(tmp_path, "landed")
    n = landing.land_files(whole, folder, ".pb")
    assert n == pings.select("source").distinct().count() > 5
    with open(f"{folder}/poll/broken.pb", "wb") as out:
        out.write(whole.first().content[:-2])
    open(f"{folder}/poll/empty.pb", "wb").close()
    open(f"{folder}/poll/other.txt", "wb").close()
    table = new(tmp_path, "pings")
    stream = positions.stream_snapshots(spark, folder, files_per_batch=-(-n // 3))
    positions.ingest_snapshots(stream, table, new(tmp_path, "progress"))
    assert len([f for f in os.listdir(table) if f.startswith("batch=")]) >= 3
    keys = ["vehicle_id", "ts", "trip_id", "bearing"]
    got = positions.ingested_pings(spark, table)
    assert plain(got.select(*keys)) == plain(pings.select(*keys))
    assert got.filter("vehicle_id is null").count() == 0
    bad = positions.ingested_quarantine(spark, table).collect()
    assert [(os.path.basename(r.source), r.status) for r in bad] == [("broken.pb", "corrupt")]


def test_many_small_snapshots_cost_few_tasks_and_no_frames(spark, tmp_path):
    rows = some_pings(5, 200)
    pings = spark.createDataFrame(rows, PINGS).withColumn("source", F.expr("'poll/' || (ts div 60)"))
    whole = landing.encode_snapshots(pings)
    folder, table = new(tmp_path, "landed"), new(tmp_path, "pings")
    n = landing.land_files(whole, folder, ".pb")
    cores = spark.sparkContext.defaultParallelism
    assert n > 4 * cores  # a lookup task per file was more than this
    with open(f"{folder}/poll/broken.pb", "wb") as out:
        out.write(whole.first().content[:-2])
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, during = spark.conf.get(setting), []
    decoded = positions.stream_snapshots(spark, folder)
    started = positions._started

    def noted(writer, checkpoint):
        during.append(int(spark.conf.get(setting)))
        return started(writer, checkpoint)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(positions, "_started", noted)
        positions.ingest_snapshots(decoded, table, new(tmp_path, "progress"))
    assert during == [min(int(before), 4 * cores)] and spark.conf.get(setting) == before
    assert plain(positions.ingested_pings(spark, table).select("vehicle_id", "ts")) == plain(pings.select("vehicle_id", "ts"))
    bad = positions.ingested_quarantine(spark, table)
    assert [(os.path.basename(r.source), r.status, r.batch) for r in bad.collect()] == [("broken.pb", "corrupt", 0)]
    assert "Join" not in bad._jdf.queryExecution().executedPlan().toString()
    files = spark.createDataFrame([("s", bytearray(whole.first().content))], "source string, content binary")
    for df in (whole, decode_position_snapshots(files)):
        assert "MapInPandas" not in df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- quality


def quality_rows(df):
    return sorted((tuple(r[c] for c in ("service_date", *positions._COUNTERS)) for r in df.collect()), key=repr)


def test_quality_closes_days_and_reopens_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(positions, "MOST_FOLDERS", 3)
    rows = sorted(some_pings(11, 500), key=lambda r: r[6])
    table = positions.QualityTable(spark, new(tmp_path, "quality"), open_days=1)
    size = -(-len(rows) // 10)
    batches = [rows[k : k + size] for k in range(0, len(rows), size)]
    opened = []
    for number, part in enumerate(batches):
        batch = spark.createDataFrame(part, PINGS)
        table.add(batch, BOX, number)
        table.add(batch, BOX, number)  # repeated after its commit: nothing changes
        opened.append(len(table.open_folders()))
    whole = parse_quality_by_day(spark.createDataFrame(rows, PINGS), BOX)
    assert quality_rows(table.quality()) == quality_rows(whole)
    assert max(opened) <= 2 * (positions.MOST_FOLDERS + 1)
    notes = table.parts.current()
    assert sum("note" in part for part in notes.values()) == 5
    # a repeat and a new report of the first day arrive late: only that day is read again
    first = min(r[6] for r in rows)
    late = [next(r for r in rows if r[6] == first), ("new", "T9", "R1", 53.8, -1.5, None, first, rows[0][7], 1)]
    table.add(spark.createDataFrame(late, PINGS), BOX, len(batches))
    whole = parse_quality_by_day(spark.createDataFrame(rows + late, PINGS), BOX)
    assert quality_rows(table.quality()) == quality_rows(whole)
    after = table.parts.current()
    assert [d for d in notes if after[d] != notes[d]] == [str(rows[0][7])]


def test_quality_of_a_stream(spark, tmp_path):
    rows = some_pings(12, 200)
    folder = new(tmp_path, "in")
    land(spark, rows, PINGS, folder, 3)
    got = positions.stream_quality(stream_of(spark, PINGS, folder), BOX, new(tmp_path, "q"), new(tmp_path, "p"))
    assert quality_rows(got) == quality_rows(parse_quality_by_day(spark.createDataFrame(rows, PINGS), BOX))


# ---------------------------------------------------------------- tables in parts

NOTICES = "situation_id string, summary string, fetched_at string, snapshot_id bigint"


def notices(ids, version):
    return [(f"S{i}", f"text {i} {version} " + "x" * 50, f"2024-01-{version + 1:02d}T00:00:00Z", version) for i in ids]


def test_ten_upserts_write_what_their_batches_touch(spark, tmp_path):
    table = Parts(spark, new(tmp_path, "latest"))
    rng = random.Random(1)
    everything = notices(range(3000), 0)
    reports = [situations.apply_snapshot(table, spark.createDataFrame(everything, NOTICES), 0, 32)]
    for batch in range(1, 11):
        part = notices(rng.sample(range(3300), 4), batch) + notices([1], batch - 1)
        everything += part
        arriving = spark.createDataFrame(part, NOTICES)
        reports.append(situations.apply_snapshot(table, arriving, batch, 32))
        assert situations.apply_snapshot(table, arriving, batch, 32) is None
    whole = situations.latest_situation(spark.createDataFrame(everything, NOTICES))
    got = table.read(folders_of(table.current()), whole.schema)
    assert plain(got) == plain(whole)
    for report in reports[1:]:
        assert report["buckets_touched"] <= 5
        assert report["bytes_written"] <= report["bytes_of_table"] * 7 / 32
    # what was replaced is gone: each bucket has the folder that counts and, at most, the one before
    folders = {f"{r}/{d}" for r, dirs, _ in os.walk(table.path) for d in dirs if d.startswith("_bucket=")}
    assert len(folders) <= 32 + 2 * 5
    assert len(os.listdir(f"{table.path}/commits")) <= 4  # two commits and their checksums
    assert not [d for d in os.listdir(table.path) if d.startswith("arriving=")]


def test_a_batch_that_stops_before_its_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    table = Parts(spark, new(tmp_path, "latest"))
    first = spark.createDataFrame(notices(range(20), 0), NOTICES)
    upsert_batch(table, first, 0, ["situation_id"], situations.latest_situation, 4)
    before = plain(table.read(folders_of(table.current()), first.schema))
    second = spark.createDataFrame(notices(range(5, 30), 1), NOTICES)
    with monkeypatch.context() as m:
        m.setattr(Parts, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            upsert_batch(table, second, 1, ["situation_id"], situations.latest_situation, 4)
    assert plain(table.read(folders_of(table.current()), first.schema)) == before
    upsert_batch(table, second, 1, ["situation_id"], situations.latest_situation, 4)
    got = table.read(folders_of(table.current()), first.schema)
    assert plain(got) == plain(situations.latest_situation(first.unionByName(second)))


def test_upsert_of_nothing_and_of_null_keys(spark, tmp_path):
    table = Parts(spark, new(tmp_path, "latest"))
    empty = spark.createDataFrame([], NOTICES)
    assert upsert_batch(table, empty, 0, ["situation_id"], situations.latest_situation)["buckets_touched"] == 0
    assert table.read(folders_of(table.current()), empty.schema).count() == 0
    some = spark.createDataFrame([(None, "a", "1", 1), (None, "b", "2", 2)], NOTICES)
    upsert_batch(table, some, 1, ["situation_id"], situations.latest_situation)
    assert plain(table.read(folders_of(table.current()), empty.schema)) == [(None, "b", "2", 2)]
    assert some.select(bucket_of(["situation_id"], 8).alias("b")).distinct().count() == 1


def test_latest_situations_over_many_batches(spark, tables, tmp_path):
    snapshots = tables.situation_snapshots
    snapshots.repartition(4).write.parquet(f"{tmp_path}/in")
    stream = (
        spark.readStream.schema(snapshots.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    )
    got, done = situations.stream_situations(stream, f"{tmp_path}/state", f"{tmp_path}/progress", 8)
    keys = ("situation_id", "fetched_at", "snapshot_id")
    assert sorted(got.select(*keys).collect()) == sorted(tables.situations_latest.select(*keys).collect())
    assert len(done) == 4


@pytest.mark.parametrize("name", ["upsert_batches", "stream_situations"])
def test_notices_are_decoded_once(spark, tables, monkeypatch, name):
    from pyspark.sql.types import StringType

    from timepoint.plans import QUERIES
    from timepoint.plans.binding import Tables

    seen = spark.sparkContext.accumulator(0)

    def counted(text):
        seen.add(1)
        return text

    notices = tables.situation_snapshots.limit(60).cache()
    n = notices.count()
    passed = F.udf(counted, StringType()).asNondeterministic()
    monkeypatch.setattr(Tables, "situation_snapshots", notices.withColumn("summary", passed("summary")))
    QUERIES[name](spark, tables.sf_dir).collect()
    assert n > 0 and seen.value == n
    notices.unpersist()


def test_dedup_writes_state_only_where_it_changes(spark):
    from pyspark.sql import Row
    from pyspark.sql import types as T

    class State:
        def __init__(self):
            self.held, self.writes = [], 0

        def exists(self):
            return bool(self.held)

        def get(self):
            return self.held

        def put(self, rows):
            self.held, self.writes = rows, self.writes + 1

        update = put

        def clear(self):
            self.put([])

    best, clock = State(), State()

    class Handle:
        def getListState(self, *_):  # noqa: N802
            return best

        def getValueState(self, *_):  # noqa: N802
            return clock

    kind = T.StructType.fromDDL(PINGS)
    one = positions.BestReports(kind, DAY)
    one.init(Handle())
    report = Row(*kind.fieldNames())
    first = report("V1", "T1", "R1", 53.8, -1.5, None, EPOCH, dt.date(2024, 1, 1), 7)
    assert [r.late for r in one.handleInputRows(("V1", 0), iter([first, first]), None)] == [False]
    assert (best.writes, clock.writes) == (1, 1)
    assert list(one.handleInputRows(("V1", 0), iter([first]), None)) == []
    assert (best.writes, clock.writes) == (1, 1)
    late = report("V1", "T1", "R1", 53.8, -1.5, None, EPOCH - 2 * DAY, dt.date(2024, 1, 1), 7)
    assert [r.late for r in one.handleInputRows(("V1", 0), iter([late]), None)] == [True]
    assert (best.writes, clock.writes) == (1, 1)


def test_dedup_takes_reports_without_a_time(spark, tmp_path):
    rows = some_pings(11, 40) + [("V1", "T1", "R1", 1.0, 2.0, None, None, None, None)] * 2
    rows += [("V1", None, "R0", 1.0, 2.0, None, None, None, 3)]
    folder, table, progress = (new(tmp_path, x) for x in ("in", "out", "progress"))
    land(spark, rows, PINGS, folder, 2)
    positions.run_dedup(stream_of(spark, PINGS, folder), table, progress)
    schema = spark.createDataFrame([], PINGS).schema
    got = positions.deduped_pings(spark, table, schema)
    assert plain(got) == plain(dedup_pings(spark.createDataFrame(rows, PINGS)))
