"""Parquet, JSON and CSV storage, plus stable intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

#: Whether files of a shuffle go with the run that wrote them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The given paths that exist, on whatever file system they name."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kept = []
    for path in paths:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        if hadoop_path.getFileSystem(conf).exists(hadoop_path):
            kept.append(path)
    return kept


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths a glob pattern names, on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop_path.getFileSystem(conf).globStatus(hadoop_path) or []
    return [status.getPath().toString() for status in found]


def scan_partitioned(
    spark: SparkSession, path: str, predicate: Column | str | None = None
) -> DataFrame:
    """Partitioned Parquet scan; a predicate on the partition column prunes directories."""
    table = spark.read.parquet(path)
    return table if predicate is None else table.filter(predicate)


def write_partitioned(df: DataFrame, path: str, by: str = "service_date") -> None:
    """Overwrite only the partitions present in ``df``, so one day can be re-run alone.

    Rows are not shuffled to one task per date first: a date may hold a third of the table.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def append_partitioned(df: DataFrame, path: str, by: str) -> None:
    df.write.mode("append").partitionBy(by).parquet(path)


def write_result(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A result table as JSON lines or headered CSV."""
    if fmt not in ("json", "csv"):
        raise ValueError("result format must be json or csv")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def shared_directory(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="timepoint-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder.

    The result has fixed partitions and no lineage, so it survives executor loss and
    every later use sees the same rows in the same partitions.
    """
    spark = df.sparkSession
    folder = shared_directory(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet beside the checkpoints and read back, for tables read several times.

    This takes less space than a checkpoint, and a reader reads the columns it uses. What was
    shuffled for it is removed as soon as the rows are written, as nothing reads it again.
    """
    spark = df.sparkSession
    place = f"{shared_directory(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.select("*").write.parquet(place)  # a new frame takes the setting with it
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(place)
