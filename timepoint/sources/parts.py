"""Tables made of parts (a day, a bucket of keys) that are replaced one by one.

A part's rows lie in plain Parquet folders; which folders count is said by the last commit,
a small JSON file that appears by one rename. A job that stops before its commit leaves
nothing that a reader sees, and one that is repeated after it finds its number taken.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timepoint.operators.dedup import keep_latest

#: Commits whose folders stay: the last, and the one that a reader may still have in hand.
KEPT = 2


class Parts:
    """The parts of the table at ``path``: folders per part, and a note of each part's own."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(conf)

    def _path(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _commits(self) -> list[int]:
        found = self._fs.globStatus(self._path(f"{self.path}/commits/*.json")) or []
        return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found)

    def _commit(self, number: int) -> dict[str, dict]:
        stream = self._fs.open(self._path(f"{self.path}/commits/{number:09d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    @property
    def number(self) -> int:
        """Number of the last commit; -1 before the first."""
        return max(self._commits(), default=-1)

    def current(self) -> dict[str, dict]:
        """Per part its ``folders`` and its ``note``, as last committed."""
        number = self.number
        return self._commit(number) if number >= 0 else {}

    def stage(self, df: DataFrame, number: int, label: str, by: str) -> dict[str, str]:
        """Write rows for a commit to come; the folder of each value of ``by`` that has rows.

        A run that is repeated writes the same folders again.
        """
        place = f"{self.path}/{label}={number:09d}"
        df.write.mode("overwrite").partitionBy(by).parquet(place)
        found = self._fs.globStatus(self._path(f"{place}/{by}=*")) or []
        return {f.getPath().getName().split("=", 1)[1]: f.getPath().toString() for f in found}

    def commit(self, number: int, parts: Mapping[str, dict]) -> None:
        """Make ``parts`` the table, then drop what no kept commit names."""
        final = self._path(f"{self.path}/commits/{number:09d}.json")
        draft = self._path(f"{self.path}/commits/_{number:09d}.draft")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, final):
            raise RuntimeError(f"commit {number} of {self.path} exists already")
        self._drop(number)

    def _drop(self, number: int) -> None:
        commits = self._commits()
        kept = commits[-KEPT:]
        named = {f for c in kept for part in self._commit(c).values() for f in part["folders"]}
        for old in commits[:-KEPT]:
            for part in self._commit(old).values():
                for folder in set(part["folders"]) - named:
                    self._fs.delete(self._path(folder), True)
            self._fs.delete(self._path(f"{self.path}/commits/{old:09d}.json"), False)

    def read(self, folders: Sequence[str], schema: Any) -> DataFrame:
        """The rows of some folders; none give an empty table."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def bytes_of(self, folders: Sequence[str]) -> int:
        return sum(self._fs.getContentSummary(self._path(f)).getLength() for f in folders)


def folders_of(parts: Mapping[str, dict]) -> list[str]:
    return [folder for part in parts.values() for folder in part["folders"]]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Number of the bucket of a key: the first 32 bits of an MD5, so any engine can say it."""
    text = F.concat_ws("\x1f", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets


def upsert_batch(
    table: Parts,
    arriving: DataFrame,
    number: int,
    keys: Sequence[str],
    newest: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = 64,
) -> dict[str, int] | None:
    """Replace the rows of the keys that arrive; only buckets that hold one of them are rewritten.

    ``newest`` keeps one row per key (the last of ``keys`` order by default: ties by every
    column). The batch's winners are written first, which also says which buckets they touch.
    Returns what was done, or None for a batch that was committed before. A key's bucket never
    changes, so a table keeps the number of buckets it began with.
    """
    if number <= table.number:
        return None
    keep = newest or (lambda df: keep_latest(df, keys, []))
    schema = arriving.schema
    current = table.current()
    winners = keep(arriving).withColumn("_bucket", bucket_of(keys, buckets))
    arrived = table.stage(winners.repartition("_bucket"), number, "arriving", "_bucket")
    before = {b: current[b]["folders"] for b in arrived if b in current}
    old = table.read([f for folders in before.values() for f in folders], schema)
    new = table.read(list(arrived.values()), schema)
    merged = keep(old.unionByName(new)).withColumn("_bucket", bucket_of(keys, buckets))
    written = table.stage(merged.repartition("_bucket"), number, "rows", "_bucket")
    parts = current | {b: {"folders": [f]} for b, f in written.items()}
    report = {
        "batch": number,
        "buckets_touched": len(arrived),
        "bytes_arrived": table.bytes_of(list(arrived.values())),
        "bytes_written": table.bytes_of(list(written.values())),
        "bytes_of_table": table.bytes_of(folders_of(parts)),
    }
    table.commit(number, parts)
    table._fs.delete(table._path(f"{table.path}/arriving={number:09d}"), True)
    return report
