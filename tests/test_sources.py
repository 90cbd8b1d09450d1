from __future__ import annotations

import json

from conftest import rows
from pyspark.sql import functions as F

from timepoint.settings import Settings
from timepoint.sources import areas, gtfs, positions, situations, storage, weather

FEED = """<?xml version="1.0" encoding="UTF-8"?>
<Siri xmlns="http://www.siri.org.uk/siri" version="2.0"><ServiceDelivery>
<SituationExchangeDelivery><Situations>{body}</Situations></SituationExchangeDelivery>
</ServiceDelivery></Siri>"""



def notice(number=None, stops=(), lines=(), starts=(), **fields):
    """One situation element; ``stops`` has a list of references per consequence."""
    tags = [f"<{tag}>{text}</{tag}>" for tag, text in fields.items()]
    if number is not None:
        tags.insert(0, f"<SituationNumber>{number}</SituationNumber>")
    tags += [f"<ValidityPeriod><StartTime>{t}</StartTime></ValidityPeriod>" for t in starts]
    named = [
        "".join(f"<AffectedStopPoint><StopPointRef>{ref}</StopPointRef></AffectedStopPoint>" for ref in refs)
        for refs in stops
    ]
    on_lines = "".join(
        f"<AffectedNetwork><AffectedLine><LineRef>{x}</LineRef></AffectedLine></AffectedNetwork>"
        for x in lines
    )
    affects = [f"<StopPoints>{x}</StopPoints>" for x in named] + ([f"<Networks>{on_lines}</Networks>"] if lines else [])
    if affects:
        each = "".join(f"<Consequence><Affects>{x}</Affects></Consequence>" for x in affects)
        tags.append(f"<Consequences>{each}</Consequences>")
    return f"<PtSituationElement>{''.join(tags)}</PtSituationElement>"


def kept_notices(spark, folder, prefix, *notices):
    (folder / "feed.xml").write_text(FEED.format(body="".join(notices)))
    flat = situations.flatten_situations(situations.read_situation_files(spark, str(folder)), [])
    return {r["situation_id"]: r for r in situations.filter_situations_region(flat, prefix).collect()}


def test_notices_of_several_consequences(spark, tmp_path):
    got = kept_notices(
        spark,
        tmp_path,
        "77",
        notice("N9", [["770001", "88"], [], ["7712"]], ["L4", "L5"], ["2031-02-03T04:05:06Z", "2032-01-01T00:00:00Z"],
               Progress="closed", EquipmentReason="liftFailure", Planned="true", Summary="  Lift out "),
    )
    row = got["N9"]
    assert (row["wy_stop_refs"], row["n_affected_stops"], row["wy_specific"]) == ("770001,7712", 3, True)
    assert (row["progress"], row["reason"], row["planned"]) == ("closed", "liftFailure", True)
    assert (row["validity_start"], row["validity_end"]) == ("2031-02-03T04:05:06Z", None)
    assert row["summary"] == "Lift out" and row["line_refs"] == "L4,L5"


def test_notices_at_the_edge_of_the_prefix(spark, tmp_path):
    got = kept_notices(
        spark,
        tmp_path,
        "77",
        notice("exact", [["77"]]),
        notice("short", [["7"]]),
        notice("inside", [["1770001"]]),
        notice("none", Planned="maybe"),
        notice(None, [["771"]], Summary="no number"),
    )
    assert set(got) == {"exact", "none", None}
    assert got["none"]["n_affected_stops"] == 0 and got["none"]["wy_specific"] is False
    assert got["none"]["planned"] is False and got["none"]["reason"] is None
    assert got[None]["wy_stop_refs"] == "771"


def test_empty_situation_file_keeps_columns(spark, tmp_path):
    (tmp_path / "1.xml").write_text(FEED.format(body=""))
    flat = situations.flatten_situations(situations.read_situation_files(spark, str(tmp_path)), [])
    kept = situations.filter_situations_region(flat, "450")
    assert kept.count() == 0
    assert {"situation_id", "wy_stop_refs", "wy_specific"} <= set(kept.columns)


def test_gtfs_tables(spark, tmp_path):
    for day, header in (("a", "stop_id,stop_name,stop_lat,stop_lon"), ("b", "stop_name,stop_id,stop_lon,stop_lat")):
        (tmp_path / day).mkdir()
        row = "0450,High St,53.8,-1.5" if day == "a" else "High Street,0450,-1.5,53.8\nFar,9,-9.0,bad"
        (tmp_path / day / "stops.txt").write_text(f"{header}\n{row}\n")
    folders = [str(tmp_path / d) for d in ("a", "b", "missing")]
    stops = gtfs.read_gtfs_table(spark, folders, "stops")
    assert stops.count() == 3
    assert dict(stops.dtypes)["stop_id"] == "string"
    inside = gtfs.stops_in_region(stops, Settings().box)
    assert rows(inside) == [("0450", "High St", 53.8, -1.5)]
    assert gtfs.read_gtfs_table(spark, folders, "routes") is None


def test_deprivation_columns(spark, tmp_path):
    header = (
        "LSOA code (2011),Income Decile,"
        '"Index of Multiple Deprivation (IMD) Decile (where 1 is most deprived)",'
        "Index of Multiple Deprivation (IMD) Score"
    )
    (tmp_path / "imd.csv").write_text(f"{header}\nE1,9,3,41.5\nE2,1,,x\n")
    table = areas.read_imd(spark, str(tmp_path / "imd.csv"))
    assert rows(table, "lsoa_code") == [("E1", 3, 41.5), ("E2", None, None)]


def test_geojson(spark, tmp_path):
    square = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]
    feature = {"type": "Feature", "properties": {"name": "x", "LSOA11CD": "E1"}}
    polygon = feature | {"geometry": {"type": "Polygon", "coordinates": [square]}}
    multi = {
        "type": "Feature",
        "properties": {"LSOA11CD": "E2"},
        "geometry": {"type": "MultiPolygon", "coordinates": [[square], [square, square]]},
    }
    path = tmp_path / "areas.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [polygon, multi]}))
    got = {r["lsoa_code"]: r["rings"] for r in areas.read_geojson(spark, str(path)).collect()}
    assert len(got["E1"]) == 1 and len(got["E2"]) == 3
    assert [tuple(p) for p in got["E1"][0]][:2] == [(0.0, 0.0), (1.0, 0.0)]


def test_weather_document(spark):
    doc = json.dumps(
        {"hourly": {"time": ["2026-07-02T00:00", "2026-07-02T13:00"], "precipitation": [0.0, 1.5],
                    "temperature_2m": [11.0, None], "wind_speed_10m": [5.0, 6.0]}}
    )
    got = rows(weather.weather_hourly(spark.createDataFrame([(doc,)], "document string")), "hour")
    assert [(r[1], r[2], str(r[4]), r[5]) for r in got] == [
        (0.0, 11.0, "2026-07-02", 0), (1.5, None, "2026-07-02", 13),
    ]


def _feed(*vehicles, header=1_782_979_200):
    feed = positions.feed_message_class()()
    feed.header.gtfs_realtime_version = "2.0"
    feed.header.timestamp = header
    for i, v in enumerate(vehicles):
        entity = feed.entity.add(id=f"e{i}")
        if v is None:
            continue
        entity.vehicle.position.latitude = v["lat"]
        entity.vehicle.position.longitude = v["lon"]
        if "id" in v:
            entity.vehicle.vehicle.id = v["id"]
        if "trip" in v:
            entity.vehicle.trip.trip_id = v["trip"]
        if "bearing" in v:
            entity.vehicle.position.bearing = v["bearing"]
        if "ts" in v:
            entity.vehicle.timestamp = v["ts"]
    return feed.SerializeToString()


def test_snapshot_files(spark, tmp_path):
    (tmp_path / "d1").mkdir()
    whole = _feed(
        {"lat": 53.8, "lon": -1.5, "id": "bus", "trip": "t", "bearing": 90.0, "ts": 5},
        None,
        {"lat": 1.0, "lon": -1.5},
    )
    (tmp_path / "d1" / "1.pb").write_bytes(whole)
    (tmp_path / "d1" / "2.pb").write_bytes(whole[:-3])
    (tmp_path / "d1" / "3.pb").write_bytes(_feed())
    decoded = positions.decode_position_snapshots(positions.read_snapshots(spark, str(tmp_path)))
    status = {r["source"][-4:]: r["status"] for r in positions.snapshot_status(decoded).collect()}
    assert status == {"1.pb"[-4:]: "ok", "2.pb"[-4:]: "corrupt", "3.pb"[-4:]: "empty"}
    assert positions.snapshot_quarantine(decoded).count() == 1
    pings = {r["vehicle_id"]: r for r in positions.decoded_pings(decoded).collect()}
    assert set(pings) == {"bus", "e2"}
    assert pings["bus"]["lat"] == 53.79999923706055 and pings["bus"]["bearing"] == 90.0
    assert pings["bus"]["ts"] == 5 and pings["bus"]["route_id"] is None
    assert pings["e2"]["trip_id"] is None and pings["e2"]["bearing"] is None
    assert pings["e2"]["ts"] == 1_782_979_200
    assert rows(positions.count_raw_positions(decoded)) == [(3, 2)]
    assert positions.pings_in_box(positions.decoded_pings(decoded), Settings().box).count() == 1


def test_partition_overwrite_replaces_one_day(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "x int, service_date string")
    df = df.withColumn("service_date", F.to_date("service_date"))
    storage.write_partitioned(df, path)
    storage.write_partitioned(df.filter("x = 2").withColumn("x", F.lit(9)), path)
    assert rows(storage.scan_partitioned(spark, path).select("x"), "x") == [(1,), (9,)]
    pruned = storage.scan_partitioned(spark, path, "service_date = date '2024-01-01'")
    assert "PartitionFilters: [isnotnull(service_date" in pruned._jdf.queryExecution().toString()


def test_write_result_formats(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)], "k string, v double")
    for fmt in ("json", "csv"):
        storage.write_result(df, str(tmp_path / fmt), fmt)
    assert rows(spark.read.json(str(tmp_path / "json"))) == [("a", 1.5)]
    read = spark.read.option("header", True).schema(df.schema).csv(str(tmp_path / "csv"))
    assert rows(read) == [("a", 1.5)]


def test_latest_situation_prefers_newest(spark):
    df = spark.createDataFrame(
        [("s", "2024-01-01T00:00:00", "old"), ("s", "2024-01-02T00:00:00", "new"), ("t", None, "x")],
        "situation_id string, fetched_at string, summary string",
    )
    got = rows(situations.latest_situation(df).select("situation_id", "summary"), "situation_id")
    assert got == [("s", "new"), ("t", "x")]


def test_dedup_and_quality(spark):
    pings = spark.createDataFrame(
        [
            ("2024-01-01", "v", 1, 53.8, -1.5, None),
            ("2024-01-01", "v", 1, 53.8, -1.5, "t"),
            ("2024-01-01", "v", 2, 53.8, -1.5, None),
            ("2024-01-01", "w", 1, 10.0, -1.5, "t"),
        ],
        "service_date string, vehicle_id string, ts long, lat double, lon double, trip_id string",
    )
    kept = positions.dedup_pings(pings)
    assert rows(kept.select("vehicle_id", "ts", "trip_id"), "vehicle_id", "ts") == [
        ("v", 1, "t"), ("v", 2, None), ("w", 1, "t"),
    ]
    day = positions.parse_quality_by_day(pings, Settings().box).first().asDict()
    assert day == {
        "service_date": "2024-01-01", "raw_pings": 3, "deduped_pings": 2, "out_of_bbox": 1,
        "with_trip_id": 1, "duplicate_share": 0.3333, "trip_id_share": 0.5,
    }


def test_stored_rows_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    """what was shuffled for a table that is read several times stayed on disk beside the next shuffles."""
    from timepoint.sources import storage

    monkeypatch.setattr(storage, "shared_directory", lambda _: str(tmp_path))
    rows = spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").count()
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        blocks = store.getAllBlocks()
        return {str(blocks.apply(i)) for i in range(blocks.size()) if "shuffle" in str(blocks.apply(i))}

    before = shuffled()
    kept = storage.stored(rows)
    assert shuffled() <= before
    assert kept.dtypes == rows.dtypes and sorted(kept.collect()) == sorted(rows.collect())
    assert not list(tmp_path.glob("rdd*")) and list(tmp_path.glob("stored-*/*.parquet"))
