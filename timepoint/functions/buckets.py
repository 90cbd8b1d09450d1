"""Bucketing, clamping, classing and display helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report buckets.
TRIP_EDGES = (0.0, 2.0, 5.0, 10.0, 20.0, float("inf"))
TRIP_LABELS = ("1-2", "3-5", "6-10", "11-20", "20+")
RAIN_EDGES = (-0.1, 0.0, 0.5, 2.0, 100.0)
RAIN_LABELS = ("dry", "drizzle", "light", "wet")


def bucket_right_closed(
    x: Column,
    edges: Sequence[float],
    labels: Sequence[str | int],
    include_lowest: bool = False,
) -> Column:
    """Label of the ``(edges[i], edges[i+1]]`` interval holding x, else NULL."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label fewer than edges")
    low, high = edges[0], edges[-1]
    inside = (x >= low) if include_lowest else (x > low)
    named: Column | None = None
    for upper, label in zip(edges[1:], labels):
        hit = inside if upper == float("inf") else inside & (x <= upper)
        named = F.when(hit, label) if named is None else named.when(hit, label)
    assert named is not None and high > low
    return named


def clip(x: Column, low: float, high: float) -> Column:
    """Clamp; NULL stays NULL (greatest/least alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


def status_class(rate: Column, good: float = 0.85, fair: float = 0.60) -> Column:
    return F.when(rate >= good, "green").when(rate >= fair, "orange").otherwise("red")


def pct_round(share: Column, digits: int = 1) -> Column:
    return F.round(share * F.lit(100.0), digits)


def display_rank(value: Column, order: Sequence[str]) -> Column:
    """1-based position in a fixed display order; NULL for values outside it."""
    return F.nullif(F.array_position(F.array(*map(F.lit, order)), value), F.lit(0))
