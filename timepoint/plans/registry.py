"""Registration of queries with their SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timepoint.plans.binding import Tables
from timepoint.plans.oracle import assemble

DIGITS = 8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at the precision compared with SQL; engines add floats in different orders."""
    doubles = {
        f.name: F.round(F.col(f.name), DIGITS)
        for f in df.schema
        if isinstance(f.dataType, T.DoubleType)
    }
    return df.withColumns(doubles)


def query(
    name: str, sql: str | None = None, doubles: str = ""
) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register ``fn(tables)`` as query ``name``; without SQL it is checked by tests only."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = assemble(sql, doubles, DIGITS)
        return fn

    return register
