"""Deterministic row selection per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per key: the first under ``order``, ties broken by every other column.

    ``row_number() = 1`` lets Spark put a group limit in front of the shuffle, so each task
    sends at most one row per key and a hot key costs no more than a cold one.
    """
    rest = [c for c, t in df.dtypes if c not in keys and not t.startswith("map")]
    ranking = [*(order or []), *rest] or [F.lit(1)]
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key, preferring the largest ``newest`` values (NULLs lose)."""
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in newest])
