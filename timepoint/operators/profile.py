"""Descriptive profiles of any table: nulls, moments, histograms, boxes, correlations."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timepoint.functions.buckets import clip
from timepoint.functions.timeofday import DAY_NAMES
from timepoint.settings import Settings
from timepoint.sources.storage import checkpointed


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, total), all columns counted in one aggregate."""
    names = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *(F.count_if(F.col(c).isNull()).alias(c) for c in names),
    )
    return counts.unpivot(["_total"], names, "column", "nulls").select(
        "column", "nulls", F.col("_total").alias("total")
    )


def approx_cardinality(df: DataFrame, columns: Sequence[str], rsd: float = 0.05) -> DataFrame:
    """HyperLogLog++ distinct counts of several columns in one pass."""
    return df.agg(*(F.approx_count_distinct(c, rsd).alias(c) for c in columns))


#: Splitting points of a narrowing round, accuracy of the sketch they come from, and the number
#: of rows that needs no more rounds.
SPLITS, ACCURACY, FEW = 1_000, 20_000, 100_000


def _narrowed(values: DataFrame, fraction: float, few: int) -> tuple[DataFrame, int, int]:
    """The values that may stand at the fraction's ranks, how many rows lie under them, and all.

    A round takes splitting points of the values left, keeps the few between which the ranks
    must lie (the sketch's error is far below the margin), and counts exactly what lies under
    them; the driver sees two values and two counts. It ends with few rows, or with few values
    that many rows have.
    """
    x = F.col("x")
    points = F.array(*(F.lit(k / SPLITS) for k in range(SPLITS + 1)))
    kind = values.schema["x"].dataType
    n = total = values.count()
    below, left = 0, values
    rank = fraction * max(total - 1, 0)
    while n > few:
        splits, low, high = left.agg(F.percentile_approx("x", points, ACCURACY), F.min("x"), F.max("x")).first()
        under = math.floor((math.floor(rank) - below) / n * SPLITS) - 3
        over = math.ceil((math.ceil(rank) + 1 - below) / n * SPLITS) + 3
        new_low = splits[under] if under >= 0 else low
        new_high = splits[over] if over <= SPLITS else high
        if (new_low, new_high) == (low, high):
            break
        ends = F.lit(new_low).cast(kind), F.lit(new_high).cast(kind)
        here, under_it = left.agg(F.count_if(x.between(*ends)), F.count_if(x < ends[0])).first()
        left, n, below = left.filter(x.between(*ends)), here, below + under_it
    return left, below, total


def exact_quantile(
    df: DataFrame, column: str, fraction: float = 0.5, how: str = "linear", few: int = FEW
) -> DataFrame:
    """One row (quantile): exact, interpolated (``linear``) or the ``lower`` value; NULL for none.

    NULL and NaN are left out. Counting rounds narrow the range in which the rank lies until at
    most ``few`` rows or one crowded stretch of equal values is left; of those the different
    values are counted and sorted. Each round reads ``df`` twice, at the call, so hand in a table
    or a materialised result; up to ``few`` rows are read twice in all.
    """
    if not 0.0 <= fraction <= 1.0 or how not in ("linear", "lower"):
        raise ValueError("fraction must be within 0 and 1, how linear or lower")
    x = F.col(column)
    plain = x.isNotNull() & ~F.isnan(x.cast("double"))
    rest, below, total = _narrowed(df.filter(plain).select(x.alias("x")), fraction, few)
    rank = fraction * max(total - 1, 0)
    counts = rest.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    listed = counts.agg(F.sort_array(F.collect_list(F.struct("x", "n"))).alias("v"))

    def at(place: int) -> Column:
        """The value of a rank: the first whose running count is beyond it."""
        seen = F.struct(F.lit(below).cast("long").alias("c"), F.lit(None).cast(rest.schema["x"].dataType).alias("x"))

        def step(s: Column, e: Column) -> Column:
            found = F.when(s["c"] + e["n"] > place, e["x"])
            return F.struct((s["c"] + e["n"]).alias("c"), F.coalesce(s["x"], found).alias("x"))

        return F.aggregate("v", seen, step)["x"]

    low, high = at(math.floor(rank)), at(math.ceil(rank))
    if how == "lower":
        return listed.select(low.alias("quantile"))
    part = rank - math.floor(rank)
    if part == 0:
        return listed.select(low.cast("double").alias("quantile"))
    linear = F.lit(1 - part) * low.cast("double") + F.lit(part) * high.cast("double")
    return listed.select(linear.alias("quantile"))


def exact_lower_median(df: DataFrame, column: str) -> DataFrame:
    """One row (median): the value half of the others are not below; NULL for no values."""
    return exact_quantile(df, column, 0.5, "lower").withColumnRenamed("quantile", "median")


def moments(df: DataFrame, column: str) -> DataFrame:
    """Mean, exact lower median, sample sd, population skewness and excess kurtosis.

    The median reads ``df`` again (see :func:`exact_quantile`): hand in a table, not a chain.
    """
    rest = df.agg(
        F.mean(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.skewness(column).alias("skewness"),
        F.kurtosis(column).alias("kurtosis"),
    )
    median = exact_lower_median(df, column).scalar().alias("median")
    return rest.select("mean", median, "std", "skewness", "kurtosis")


def describe_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Typed count, mean, sd, min and max per column, from one aggregate."""
    parts = df.agg(
        F.array(
            *(
                F.struct(
                    F.lit(c).alias("column"),
                    F.count(c).alias("count"),
                    F.mean(c).alias("mean"),
                    F.stddev_samp(c).alias("stddev"),
                    F.min(c).cast("double").alias("min"),
                    F.max(c).cast("double").alias("max"),
                )
                for c in columns
            )
        ).alias("rows")
    )
    return parts.select(F.inline("rows"))


def service_intensity(headways: DataFrame) -> DataFrame:
    return headways.groupBy("time_band").agg(
        F.count(F.lit(1)).alias("route_bands"),
        F.avg("sched_headway_mean_min").alias("mean_headway_min"),
    )


ON_TIME_KEYS = ("hour", "day_of_week", "time_band")


def on_time_profile(trips: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """On-time percentage by hour, by weekday and by band in one pass.

    Trips are first counted per (hour, weekday, band), a few hundred combinations, and the
    three groupings are taken from those counts.
    """
    flag = settings.primary_flag
    cells = trips.groupBy(*ON_TIME_KEYS).agg(
        F.sum(flag).alias("hits"), F.count(flag).alias("trips")
    )
    sides = F.array(
        *(
            F.struct(F.lit(k).alias("grouping"), F.col(k).cast("string").alias("value"))
            for k in ON_TIME_KEYS
        )
    )
    return (
        cells.select("hits", "trips", F.inline(sides))
        .filter(F.col("value").isNotNull())
        .groupBy("grouping", "value")
        .agg(
            (F.sum("hits") * F.lit(100.0) / F.sum("trips")).alias("on_time_pct"),
            F.sum("trips").alias("n"),
        )
    )


def on_time_by(trips: DataFrame, key: str, settings: Settings = Settings()) -> DataFrame:
    """One grouping of :func:`on_time_profile`, with its fixed display position."""
    order = {"day_of_week": DAY_NAMES, "time_band": settings.band_order}.get(key)
    part = on_time_profile(trips, settings).filter(F.col("grouping") == key)
    position = (
        F.array_position(F.array(*map(F.lit, order)), F.col("value"))
        if order
        else F.col("value").cast("long")
    )
    return part.select(F.col("value").alias(key), position.alias("position"), "on_time_pct", "n")


def delay_by_stop_sequence(delays: DataFrame, last: int = 40) -> DataFrame:
    """Interpolated median delay per stop number."""
    return (
        delays.filter(F.col("stop_sequence") <= last)
        .groupBy("stop_sequence")
        .agg(F.median("delay_min").alias("median_delay"), F.count(F.lit(1)).alias("n"))
    )


def histogram(
    df: DataFrame, column: str, bins: int, clip_to: tuple[float, float] | None = None
) -> DataFrame:
    """Equal-width counts over the (clipped) data range; the last bin is closed.

    Equal values are counted once and the counts pinned; range and bins run on them. Empty
    bins are kept.
    """
    value = F.col(column).cast("double")
    if clip_to is not None:
        value = clip(value, *clip_to)
    values = checkpointed(
        df.select(value.alias("x"))
        .filter(F.col("x").isNotNull())
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    ends = values.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    ranged = values.withColumns({"low": low, "high": high})
    flat = F.col("low") == F.col("high")
    ranged = ranged.withColumns(
        {
            "from": F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")),
            "width": F.when(flat, F.lit(1.0)).otherwise(F.col("high") - F.col("low"))
            / F.lit(float(bins)),
        }
    )
    slot = F.least(F.floor((F.col("x") - F.col("from")) / F.col("width")), F.lit(bins - 1))
    counts = ranged.groupBy(slot.alias("bin"), "from", "width").agg(F.sum("times").alias("n"))
    shape = counts.agg(F.max("from").alias("from"), F.max("width").alias("width"))
    spine = shape.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (
        spine.filter(F.col("width").isNotNull())
        .join(counts.select("bin", "n"), "bin", "left")
        .select(
            F.col("bin").cast("long").alias("bin"),
            (F.col("from") + F.col("bin") * F.col("width")).alias("bin_low"),
            (F.col("from") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        )
    )


def class_balance(rows: DataFrame, label: str = "compliant") -> DataFrame:
    """Count and share of both labels, zeros included, from one aggregate."""
    counts = rows.agg(
        F.count(label).alias("total"),
        *(F.count_if(F.col(label) == v).alias(f"n{v}") for v in (0, 1)),
    )
    listed = F.array(
        *(F.struct(F.lit(v).alias("label"), F.col(f"n{v}").alias("n")) for v in (0, 1))
    )
    return counts.select("total", F.inline(listed)).select(
        "label", "n", F.coalesce(F.try_divide("n", "total"), F.lit(0.0)).alias("share")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations in long form, one pass over the rows.

    Rows are summed per pattern of NULLs: a pair's complete rows are those of the patterns that
    have both, so plain sums of values and products, at most one small row per pattern, hold
    every pair. Values are taken relative to their column's middle, which keeps sums of squares
    from cancelling. A constant column has no correlation (NULL).
    """
    names = list(columns)
    k = len(names)
    if k > 62:
        raise ValueError("a pattern of NULLs has room for 62 columns")
    values = df.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)))
    ends = values.agg(F.array(*((F.min(f"c{i}") + F.max(f"c{i}")) / 2 for i in range(k)))).scalar()
    pattern = sum((F.when(F.col(f"c{i}").isNotNull(), F.lit(1 << i)).otherwise(0) for i in range(k)), F.lit(0).cast("long"))
    moved = values.withColumn("_m", ends).select(
        pattern.alias("pattern"),
        *(F.coalesce(F.col(f"c{i}") - F.get("_m", F.lit(i)), F.lit(0.0)).alias(f"c{i}") for i in range(k)),
    )
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = moved.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*(F.sum(f"c{i}") for i in range(k))).alias("s"),
        F.array(*(F.min(f"c{i}") for i in range(k))).alias("low"),
        F.array(*(F.max(f"c{i}") for i in range(k))).alias("high"),
        F.array(*(F.sum(F.col(f"c{i}") * F.col(f"c{j}")) for i, j in pairs)).alias("p"),
    )
    place = {pair: at for at, pair in enumerate(pairs)}
    listed = F.array(
        *(
            F.struct(
                F.lit(i).alias("i"),
                F.lit(j).alias("j"),
                F.col("s")[i].alias("x"),
                F.col("s")[j].alias("y"),
                F.col("p")[place[i, j]].alias("xy"),
                F.col("p")[place[i, i]].alias("xx"),
                F.col("p")[place[j, j]].alias("yy"),
                *(F.col(end)[c].alias(f"{end}_{side}") for end in ("low", "high") for side, c in (("x", i), ("y", j))),
            )
            for i, j in pairs
        )
    )
    both = F.expr("shiftleft(1L, i) | shiftleft(1L, j)")
    rows = sums.select("pattern", "n", F.inline(listed)).withColumn(
        "complete", F.col("pattern").bitwiseAND(both) == both
    )

    def part(how: Callable[[Column], Column], column: str) -> Column:
        return how(F.when(F.col("complete"), F.col(column))).alias(column)

    whole = rows.groupBy("i", "j").agg(
        *(part(F.sum, c) for c in ("n", "x", "y", "xy", "xx", "yy")),
        *(part(F.min, c) for c in ("low_x", "low_y")),
        *(part(F.max, c) for c in ("high_x", "high_y")),
    )
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    spread = F.sqrt((F.col("xx") - x * x / n) * (F.col("yy") - y * y / n))
    # a constant column leaves only rounding noise in its variance
    varies = (F.col("high_x") > F.col("low_x")) & (F.col("high_y") > F.col("low_y"))
    same = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.try_divide(F.col("xy") - x * y / n, spread))
    named = F.array(*map(F.lit, names))
    sides = F.array(F.struct(F.col("i").alias("a"), F.col("j").alias("b")), F.struct(F.col("j").alias("a"), F.col("i").alias("b")))
    return (
        whole.select(F.when(varies, same).alias("correlation"), F.explode(F.array_distinct(sides)).alias("s"))
        .select(F.get(named, F.col("s.a")).alias("a"), F.get(named, F.col("s.b")).alias("b"), "correlation")
    )


def box_stats(
    df: DataFrame, key: str, column: str, clip_to: tuple[float, float] = (-10.0, 20.0)
) -> DataFrame:
    """Quartiles and 1.5-IQR whiskers (actual data points) per key, outliers left out.

    Clipped delays have a bounded number of distinct hundredths, so values are counted per
    (key, value) first and both steps run on those counts.
    """
    value = clip(F.col(column).cast("double"), *clip_to)
    counts = (
        df.filter(F.col(key).isNotNull() & F.col(column).isNotNull())
        .groupBy(key, value.alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    quartiles = counts.groupBy(key).agg(
        F.expr("percentile(x, array(0.25D, 0.5D, 0.75D), n)").alias("q"), F.sum("n").alias("n")
    ).select(
        key, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "n"
    )
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5)
    fenced = counts.drop("n").join(quartiles, key).filter(
        F.col("x").between(F.round(F.col("q1") - reach, 9), F.round(F.col("q3") + reach, 9))
    )
    return fenced.groupBy(key).agg(
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min("x").alias("whisker_low"),
        F.max("x").alias("whisker_high"),
        F.max("n").alias("n"),
    )


def delay_quantiles(delays: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Median, 90th percentile (linear) and share within the primary window, all matches."""
    low, high = settings.on_time
    inside = F.col("delay_min").between(float(low), float(high)).cast("double")
    counts = delays.groupBy("delay_min").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.expr("percentile(delay_min, 0.5D, n)").alias("median_delay"),
        F.expr("percentile(delay_min, 0.9D, n)").alias("p90_delay"),
        F.try_divide(F.sum(inside * F.col("n")), F.sum("n")).alias("within_window"),
    )


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(position, stage, records) of several tables, counted in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(i).alias("position"), F.lit(name).alias("stage"), "records"
        )
        for i, (name, df) in enumerate(stages.items(), 1)
    ]
    funnel = parts[0]
    for part in parts[1:]:
        funnel = funnel.unionByName(part)
    return funnel


def record_counts(datasets: Mapping[str, DataFrame], not_summed: Sequence[str] = ()) -> DataFrame:
    """Records per dataset and their TOTAL; ``not_summed`` datasets are listed only."""
    counts = stage_counts(datasets).select(F.col("stage").alias("dataset"), "records")
    total = counts.filter(~F.col("dataset").isin(list(not_summed))).agg(
        F.lit("TOTAL").alias("dataset"), F.sum("records").alias("records")
    )
    return counts.unionByName(total)
