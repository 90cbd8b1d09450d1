"""Global ordering without a single-task window: running totals, ranks, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timepoint.sources.storage import checkpointed


def running_totals(
    totals: DataFrame,
    order: Sequence[Column],
    sums: Sequence[str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<c>``: the sum of each ``c`` up to and including the row, per key.

    ``totals`` must hold one row per (key, order value). It is range-sorted and
    checkpointed, which pins its partitions; each partition then sums its own rows and
    adds what the partitions before it hold. Only one row per (key, partition) ever meets
    in one place, so neither the driver nor a task sees the whole ordering.
    """
    ordered = checkpointed(totals.orderBy(*keys, *order)).withColumn(
        "_part", F.spark_partition_id()
    )
    here = [*keys, "_part"]
    so_far = Window.partitionBy(*here).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    per_part = ordered.groupBy(*here).agg(*(F.sum(c).alias(f"_in_{c}") for c in sums))
    offsets = per_part.select(
        *here,
        *(F.coalesce(F.sum(f"_in_{c}").over(earlier), F.lit(0)).alias(f"_pre_{c}") for c in sums),
    )
    within = ordered.select("*", *(F.sum(c).over(so_far).alias(f"_cum_{c}") for c in sums))
    return (
        within.join(offsets, here)
        .withColumns({f"cum_{c}": F.col(f"_cum_{c}") + F.col(f"_pre_{c}") for c in sums})
        .drop("_part", *(f"_{kind}_{c}" for c in sums for kind in ("pre", "cum")))
    )


def average_ranks(counts: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rank of every distinct value when ties share their mean rank.

    ``counts`` has one row per (key, value) with its number of occurrences ``n``.
    """
    ranked = running_totals(counts, [F.col(value)], ["n"], keys)
    mean_rank = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / F.lit(2.0)
    return ranked.withColumn("rank", mean_rank).drop("cum_n")


def average_rank(df: DataFrame, column: str) -> DataFrame:
    """Add ``rank`` to every row of ``df``; NULLs have no rank.

    Rows are range-partitioned by the value and a number of their own, so a value that a third
    of all rows have lies in many partitions, and pinned there. Each partition ranks its rows
    in place; what the others hold comes from one row per partition: how many rows lie before
    it, and how often its first and its last value, the only ones it may share, occur elsewhere.
    """
    value, part = F.col(column), "_part"
    none = df.filter(value.isNull()).withColumn("rank", F.lit(None).cast("double"))
    spread = (
        df.filter(value.isNotNull())
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(value, "_row")
        .drop("_row")
    )
    rows = checkpointed(spread).withColumn(part, F.spark_partition_id())
    ranked = rows.withColumns(
        {
            "_place": F.rank().over(Window.partitionBy(part).orderBy(value)),
            "_here": F.count(F.lit(1)).over(Window.partitionBy(part, column)),
        }
    )
    parts = ranked.groupBy(part).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
        F.min_by("_here", value).alias("_n_low"),
        F.max_by("_here", value).alias("_n_high"),
    )
    ends = F.array(
        F.struct(F.col("_low").alias("_end"), F.col("_n_low").alias("_times")),
        F.struct(F.col("_high").alias("_end"), F.when(F.col("_low") < F.col("_high"), F.col("_n_high")).otherwise(0).alias("_times")),
    )
    shared = parts.select(part, F.inline(ends)).groupBy(part, "_end").agg(F.sum("_times").alias("_times"))
    by_end = Window.partitionBy("_end")
    earlier = by_end.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    known = shared.select(
        part,
        "_end",
        F.sum("_times").over(by_end).alias("_whole"),
        F.coalesce(F.sum("_times").over(earlier), F.lit(0)).alias("_earlier"),
    )
    low = known.select(part, F.col("_end").alias("_low"), F.col("_whole").alias("_whole_low"), "_earlier")
    high = known.select(part, F.col("_end").alias("_high"), F.col("_whole").alias("_whole_high"))
    before = Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(low, [part, "_low"])
        .join(high, [part, "_high"])
        .select(part, "_low", "_high", "_before", "_whole_low", "_earlier", "_whole_high")
    )
    start = F.when(value == F.col("_low"), F.col("_before") - F.col("_earlier")).otherwise(
        F.col("_before") + F.col("_place") - 1
    )
    times = (
        F.when(value == F.col("_low"), F.col("_whole_low"))
        .when(value == F.col("_high"), F.col("_whole_high"))
        .otherwise(F.col("_here"))
    )
    whole = ranked.join(offsets, part).withColumn("rank", start + (times + 1) / F.lit(2.0))
    return whole.select(*df.columns, "rank").unionByName(none)


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First k rows of a total order; each task keeps k rows, so nothing is sorted whole."""
    return df.orderBy(*order).limit(k)


def sort_output(df: DataFrame, *order: Column | str) -> DataFrame:
    """Order by the given columns, ties broken by every other column."""
    return df.orderBy(*order, *df.columns)
