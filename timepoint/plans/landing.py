"""Landing what the queries then read back: snapshot files and tables in several files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.sources.positions import feed_message_class


def encode_snapshots(pings: DataFrame) -> DataFrame:
    """Pings packed into feed messages, (source, content); the decoder's counterpart.

    Every row names its snapshot in ``source``; a snapshot is one poll's reports, so it is
    small whatever the table's size. The names do not depend on how rows fall into tasks.
    """
    fields = ["source", "vehicle_id", "trip_id", "route_id", "lat", "lon", "bearing", "ts"]

    def message_of(rows: list[tuple]) -> bytes:
        feed = feed_message_class()()
        feed.header.gtfs_realtime_version = "2.0"
        feed.header.timestamp = int(max(row[7] for row in rows))
        add = feed.entity.add
        for _, vehicle_id, trip_id, route_id, lat, lon, bearing, ts in rows:
            vehicle = add(id=vehicle_id).vehicle  # each step into a message costs an object
            vehicle.vehicle.id = vehicle_id
            vehicle.timestamp = int(ts)
            place = vehicle.position
            place.latitude, place.longitude = lat, lon
            if bearing is not None and bearing == bearing:  # NaN is none either
                place.bearing = bearing
            if trip_id is not None or route_id is not None:
                trip = vehicle.trip
                if trip_id is not None:
                    trip.trip_id = trip_id
                if route_id is not None:
                    trip.route_id = route_id
        return feed.SerializeToString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(packed: list[tuple[str, bytes]]) -> pa.RecordBatch:
            sources, contents = zip(*packed, strict=True) if packed else ((), ())
            columns = [pa.array(sources, pa.string()), pa.array(contents, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["source", "content"])

        rows: list[tuple] = []
        for batch in batches:
            packed: list[tuple[str, bytes]] = []
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if rows and rows[0][0] != row[0]:
                    packed.append((rows[0][0], message_of(rows)))
                    rows = []
                rows.append(row)
            yield batch_of(packed)
        if rows:
            yield batch_of([(rows[0][0], message_of(rows))])

    together = pings.select(*fields).repartition("source").sortWithinPartitions("source")
    return together.mapInArrow(pack, "source string, content binary")


def land_files(files: DataFrame, folder: str, suffix: str) -> int:
    """Write each (source, content) as a file of its own; the number of files.

    A file appears under its name when it is whole, and a task that is repeated writes the same
    files again. ``folder`` is any address that Arrow's file systems know.
    """
    root = "file://" + folder.removeprefix("file:") if folder.startswith("file:/") and not folder.startswith("file://") else folder

    def land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for source, content in zip(batch.column("source"), batch.column("content"), strict=True):
                name = f"{base}/{source.as_py()}{suffix}"
                store.create_dir(name.rsplit("/", 1)[0])
                with store.open_output_stream(f"{name}.part") as out:
                    out.write(content.as_buffer())
                store.move(f"{name}.part", name)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return files.mapInArrow(land, "n bigint").agg(F.sum("n")).first()[0] or 0
