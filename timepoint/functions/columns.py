"""Helpers about columns: discovery by name, NULL filling, reference lists, scores."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def discover_columns(names: Iterable[str], *fragments: str, prefix: str = "") -> list[str]:
    """Names that start with ``prefix`` and contain every fragment, ignoring case."""
    wanted = [f.lower() for f in fragments]
    return [
        n
        for n in names
        if n.lower().startswith(prefix.lower()) and all(f in n.lower() for f in wanted)
    ]


def discover_pattern(names: Iterable[str], pattern: str) -> list[str]:
    rx = re.compile(pattern, re.IGNORECASE)
    return [n for n in names if rx.search(n)]


def fill_defaults(df: DataFrame, defaults: Mapping[str, float | int]) -> DataFrame:
    """Fill NULLs column by column; a column that is absent is added as the default."""
    missing = {c: F.lit(float(v)) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing).fillna(dict(defaults))


def computed_once(df: DataFrame, **values: Column | str) -> DataFrame:
    """Add columns as generator output, so that each is evaluated once per row.

    A plain projected column is copied into every later filter and expression that uses
    it, which for text parsing or long formulas costs more than the rest of the scan.
    """
    row = F.struct(
        *((F.expr(v) if isinstance(v, str) else v).alias(name) for name, v in values.items())
    )
    return df.select("*", F.inline(F.array(row)))


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def split_refs(refs: Column) -> Column:
    """Comma-joined list -> array; empty text gives an empty array."""
    return F.when(refs == "", F.array().cast("array<string>")).otherwise(F.split(refs, ","))


def probability_of(vector: Column, slot: int = 1) -> Column:
    """Score of one class out of an ML probability vector."""
    return F.get(vector_to_array(vector), F.lit(slot))
