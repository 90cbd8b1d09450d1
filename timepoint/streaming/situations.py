"""Continuous ingestion of disruption snapshots: the latest notice per situation.

State is a table in buckets of keys (:mod:`timepoint.sources.parts`). A micro-batch rewrites
the buckets that its notices fall into and no others, so what is written follows what arrives
and not the history; folders that were replaced are dropped after the commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from timepoint.sources.parts import Parts, folders_of, upsert_batch
from timepoint.sources.situations import latest_situation
from timepoint.streaming.positions import run_batches

BUCKETS = 64


def apply_snapshot(table: Parts, arriving: DataFrame, batch: int, buckets: int = BUCKETS) -> dict | None:
    """Take the arriving notices into the table; a batch repeated after a failure changes nothing."""
    return upsert_batch(table, arriving, batch, ["situation_id"], latest_situation, buckets)


def stream_situations(
    snapshots: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS
) -> tuple[DataFrame, list[dict]]:
    """Consume all available snapshots: the latest notice per situation, and what each batch did."""
    table = Parts(snapshots.sparkSession, path)
    done: list[dict] = []

    def handle(arriving: DataFrame, batch: int) -> None:
        report = apply_snapshot(table, arriving, batch, buckets)
        if report is not None:
            done.append(report)

    run_batches(snapshots, handle, checkpoint)
    return table.read(folders_of(table.current()), snapshots.schema), done
