"""Rank correlation, permutation test and the deprivation statistics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timepoint.functions.buckets import TRIP_EDGES, TRIP_LABELS, bucket_right_closed
from timepoint.operators.ranking import average_ranks, running_totals
from timepoint.settings import Settings
from timepoint.sources.storage import checkpointed


def _rank_correlation(n: Column, sxy: Column, sxx: Column, syy: Column) -> Column:
    """Pearson on ranks from raw moments; the mean rank is (n + 1) / 2 whatever the ties."""
    mean = (n + 1) / F.lit(2.0)
    shift = n * mean * mean
    return F.try_divide(sxy - shift, F.sqrt((sxx - shift) * (syy - shift)))


def spearman_pairs(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Spearman correlation of several column pairs in one pass over ``df``.

    Rows are first reduced to counts per distinct (pair, x, y), combined map-side; ranks
    come from those counts, so rows are never ranked or joined one by one.
    """
    listed = F.array(
        *(
            F.struct(
                F.lit(name).alias("pair"),
                F.col(x).cast("double").alias("x"),
                F.col(y).cast("double").alias("y"),
            )
            for name, (x, y) in pairs.items()
        )
    )
    joint = checkpointed(
        df.select(F.inline(listed))
        .filter(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("pair", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sides = joint.select(
        "pair",
        "n",
        F.inline(
            F.array(
                F.struct(F.lit("x").alias("axis"), F.col("x").alias("value")),
                F.struct(F.lit("y").alias("axis"), F.col("y").alias("value")),
            )
        ),
    )
    counts = sides.groupBy("pair", "axis", "value").agg(F.sum("n").alias("n"))
    ranks = average_ranks(counts, "value", ["pair", "axis"])

    def side(axis: str) -> DataFrame:
        return ranks.filter(F.col("axis") == axis).select(
            "pair", F.col("value").alias(axis), F.col("rank").alias(f"r{axis}")
        )

    n, rx, ry = F.col("n"), F.col("rx"), F.col("ry")
    moments = (
        joint.join(side("x"), ["pair", "x"])
        .join(side("y"), ["pair", "y"])
        .groupBy("pair")
        .agg(
            F.sum(n).alias("n"),
            F.sum(n * rx * ry).alias("sxy"),
            F.sum(n * rx * rx).alias("sxx"),
            F.sum(n * ry * ry).alias("syy"),
        )
    )
    rho = _rank_correlation(n, F.col("sxy"), F.col("sxx"), F.col("syy"))
    return moments.select("pair", "n", rho.alias("rho"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: rank correlation rounded to four places, and the rows used."""
    return spearman_pairs(df, {"xy": (x, y)}).select(
        F.round("rho", 4).alias("spearman_rho"), F.col("n")
    )


#: Rounds of a shuffle; units up to which their ranks are sent to every task (16 bytes each).
ROUNDS, SENT_UNITS = 12, 500_000
_PRIME = (1 << 31) - 1


def _squared(z: Column) -> Column:
    """A square modulo a prime of 31 bits, which any SQL engine has in its integers."""
    rest = z % F.lit(_PRIME)
    return rest * rest % F.lit(_PRIME)


def shuffle_sides(n: int) -> tuple[int, int]:
    """Two sides whose product is ``n`` or the least that is more, near its square root."""
    root = max(1, round(n**0.5))
    sides = range(max(2, (root + 1) // 2), 2 * root + 1)  # no side of one, which would only rotate
    a = min(sides, key=lambda a: (a * -(-n // a), a))
    return a, -(-n // a)


def shuffled_slot(rows: DataFrame, n: int, seed: int, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (slot, replicate, ...) with every slot of 0 .. n-1 moved by its replicate's shuffle.

    A Feistel network on the pairs (slot div b, slot mod b) adds to each side in turn a hash of
    the other, which is a bijection of a * b slots for every (seed, replicate); a slot that
    comes out beyond n goes through it again until it is below. No slot needs to know another,
    so nothing is sorted and nothing moves.
    """
    if rounds % 4:
        raise ValueError("rounds come in fours")  # an even number leaves each side where it was
    a, b = shuffle_sides(n)
    begin = F.col("replicate") * F.lit(1_000_003) + F.lit(seed * 7_919 + 12_345)
    keyed = rows.withColumn("_k", _squared(_squared(begin) + F.col("replicate")))
    keyed = keyed.withColumns({f"_k{j}": _squared(F.col("_k") + j * 362_437) for j in range(rounds + 1)})

    def passed(left: Column, right: Column, some: Iterable[int]) -> tuple[Column, Column]:
        for j in some:
            mixed = F.shiftright(((right + 1) * F.col(f"_k{j}") + F.col(f"_k{j + 1}")) % F.lit(_PRIME), 7)
            left, right = right, (left + mixed) % F.lit(a if j % 2 == 0 else b)
        return left, right

    def halves(slot: Column) -> tuple[Column, Column]:
        return F.floor(slot / F.lit(b)).cast("long"), slot % F.lit(b)

    left, right = halves(F.col("slot"))
    for start in range(0, rounds, 4):
        # columns of their own every few rounds, as each round names both sides of the last one
        left, right = passed(left, right, range(start, start + 4))
        keyed = keyed.withColumns({"_left": left, "_right": right})
        left, right = F.col("_left"), F.col("_right")
    moved = left * F.lit(b) + right
    if a * b > n:

        def again(slot: Column) -> Column:
            left, right = passed(*halves(slot), range(rounds))
            return F.when(slot < n, slot).otherwise(left * F.lit(b) + right)

        # no cycle has more slots beyond n than there are
        moved = F.aggregate(F.sequence(F.lit(1), F.lit(a * b - n)), moved, lambda s, _: again(s))
    return keyed.withColumn("slot", F.coalesce(moved, F.lit(0))).select(*rows.columns)


def permutation_pvalue(
    df: DataFrame, unit: str, x: str, y: str, permutations: int = 10_000, seed: int = 11
) -> DataFrame:
    """Spearman rho with a two-sided permutation p-value (no +1 correction).

    ``df`` has one row per ``unit`` (a route). Replicate r gives each unit the x rank of the unit
    whose slot :func:`shuffled_slot` names, so the rows of all replicates arise and are summed
    where their unit lies: one sum per replicate and task is all that is shuffled, and any
    engine draws the same shuffles. Ranks are looked up in a copy at every task as long as there
    are at most ``SENT_UNITS`` units, beyond that by a join on the slot.
    """
    units = checkpointed(
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
            F.col(unit).cast("string").alias("unit"),
            F.col(x).cast("double").alias("x"),
            F.col(y).cast("double").alias("y"),
        )
    )

    def ranks(column: str) -> DataFrame:
        counts = units.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return average_ranks(counts, column).select(column, F.col("rank").alias(f"r{column}"))

    numbered = running_totals(units.withColumn("one", F.lit(1)), [F.col("unit")], ["one"])
    ranked = checkpointed(
        numbered.join(ranks("x"), "x")
        .join(ranks("y"), "y")
        .select((F.col("cum_one") - 1).cast("long").alias("slot"), "rx", "ry")
    )
    count = ranked.count()
    lookup = ranked.select("slot", "rx")
    tasks = ranked.sparkSession.sparkContext.defaultParallelism
    replicates = F.sequence(F.lit(1).cast("long"), F.lit(permutations).cast("long"))
    spread = ranked.select("slot", "ry").repartition(tasks, "slot")
    drawn = shuffled_slot(spread.select("slot", "ry", F.explode(replicates).alias("replicate")), count, seed)
    products = (
        drawn.join(F.broadcast(lookup) if count <= SENT_UNITS else lookup, "slot")
        .groupBy("replicate")
        .agg(F.sum(F.col("rx") * F.col("ry")).alias("sxy"))
    )
    rx, ry = F.col("rx"), F.col("ry")
    observed = ranked.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(rx * ry).alias("oxy"),
        F.sum(rx * rx).alias("sxx"),
        F.sum(ry * ry).alias("syy"),
    )

    whole = observed.select(F.struct("n", "oxy", "sxx", "syy")).scalar()
    both = products.select("sxy", whole.alias("whole")).select("sxy", "whole.*")
    n, sxx, syy = F.col("n"), F.col("sxx"), F.col("syy")
    rho = _rank_correlation(n, F.col("oxy"), sxx, syy)
    drawn_rho = _rank_correlation(n, F.col("sxy"), sxx, syy)
    # sums of floats differ in the last digits between orders of addition
    as_extreme = F.round(F.abs(drawn_rho), 12) >= F.round(F.abs(rho), 12)
    return both.agg(
        F.round(F.max(rho), 4).alias("spearman_rho"),
        F.round(F.count_if(as_extreme) / F.lit(float(permutations)), 5).alias(
            "p_value_permutation"
        ),
        F.max("n").alias("n_routes"),
    )


def per_route_compliance(facts: DataFrame) -> DataFrame:
    """Sums per route from which every averaged report is built after small joins."""
    return facts.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("band_days"),
        F.sum("compliant").alias("compliant_sum"),
        F.sum("pct_on_time").alias("on_time_sum"),
        F.sum("n_trips").alias("trips"),
    )


def _with_decile(per_route: DataFrame, dim_route: DataFrame) -> DataFrame:
    known = dim_route.filter(F.col("route_imd_decile").isNotNull())
    return per_route.join(known.select("route_id", "route_imd_decile"), "route_id")


def _mean(total: str) -> Column:
    return F.sum(total) / F.sum("band_days")


def route_equity_table(
    facts: DataFrame, dim_route: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Routes with a decile and enough band-days, with their rates."""
    routes = _with_decile(per_route_compliance(facts), dim_route)
    return routes.filter(F.col("band_days") >= settings.min_band_days_tested).select(
        "route_id",
        F.col("route_imd_decile").alias("imd_decile"),
        (F.col("compliant_sum") / F.col("band_days")).alias("compliance_rate"),
        (F.col("on_time_sum") / F.col("band_days")).alias("mean_on_time"),
        "band_days",
    )


def compliance_by_decile(
    facts: DataFrame, dim_route: DataFrame, rounded: bool = False
) -> DataFrame:
    """Rates per whole decile, truncated (warehouse) or rounded (report)."""
    decile = F.col("route_imd_decile").cast("double")
    whole = (F.round(decile) if rounded else decile).cast("int")
    return (
        _with_decile(per_route_compliance(facts), dim_route)
        .groupBy(whole.alias("imd_decile"))
        .agg(
            _mean("compliant_sum").alias("compliance_rate"),
            _mean("on_time_sum").alias("mean_on_time"),
            F.sum("band_days").alias("band_days"),
        )
        .orderBy("imd_decile")
    )


def deprivation_gap(by_decile: DataFrame) -> DataFrame:
    """Band-day weighted compliance of deciles 1-3 and 8-10 and their difference."""

    def weighted(part: Column) -> Column:
        days = F.when(part, F.col("band_days"))
        return F.round(F.try_divide(F.sum(days * F.col("compliance_rate")), F.sum(days)), 4)

    ends = by_decile.agg(
        weighted(F.col("imd_decile") <= 3).alias("deciles_1_3_compliance"),
        weighted(F.col("imd_decile") >= 8).alias("deciles_8_10_compliance"),
    )
    gap = F.col("deciles_8_10_compliance") - F.col("deciles_1_3_compliance")
    return ends.withColumn("gap_percentage_points", F.round(gap * F.lit(100.0), 2))


def frequency_buckets(facts: DataFrame, dim_route: DataFrame) -> DataFrame:
    """Compliance and punctuality per bucket of trips in the band."""
    bucket = bucket_right_closed(F.col("n_trips"), TRIP_EDGES, TRIP_LABELS)
    known = dim_route.filter(F.col("route_imd_decile").isNotNull()).select("route_id")
    return (
        facts.groupBy("route_id", bucket.alias("trips_per_band"))
        .agg(
            F.sum("compliant").alias("c"),
            F.sum("pct_on_time").alias("o"),
            F.count(F.lit(1)).alias("k"),
        )
        .join(known, "route_id", "left_semi")
        .groupBy("trips_per_band")
        .agg(
            F.round(F.sum("c") / F.sum("k"), 4).alias("compliance"),
            F.round(F.sum("o") / F.sum("k"), 4).alias("on_time"),
            F.sum("k").alias("n"),
        )
    )


CONFOUND_PAIRS = {
    "rho_n_trips_vs_imd_decile": ("n_trips", "route_imd_decile"),
    "rho_n_trips_vs_compliant": ("n_trips", "compliant"),
    "rho_n_trips_vs_pct_on_time": ("n_trips", "pct_on_time"),
}


def frequency_confound(facts: DataFrame, dim_route: DataFrame) -> DataFrame:
    """One row: how trips per band relate to decile, compliance and punctuality."""
    known = dim_route.filter(F.col("route_imd_decile").isNotNull())
    bands = facts.select("route_id", "n_trips", "compliant", "pct_on_time").join(
        known.select("route_id", "route_imd_decile"), "route_id"
    )
    rho = spearman_pairs(bands, CONFOUND_PAIRS)
    return rho.agg(
        *(
            F.round(F.max(F.when(F.col("pair") == name, F.col("rho"))), 4).alias(name)
            for name in CONFOUND_PAIRS
        )
    )


def equity_report(
    facts: DataFrame,
    dim_route: DataFrame,
    settings: Settings = Settings(),
    permutations: int = 10_000,
) -> DataFrame:
    """The whole equity result as one JSON document."""
    facts = checkpointed(facts)
    routes = checkpointed(route_equity_table(facts, dim_route, settings))
    deciles = compliance_by_decile(facts, dim_route)

    def row(df: DataFrame) -> Column:
        return df.select(F.struct("*")).scalar()

    def rows(df: DataFrame) -> Column:
        # deciles (ten) and trip buckets (five) are fixed by definition
        return df.agg(F.array_sort(F.collect_list(F.struct("*")))).scalar()

    document = F.struct(
        F.lit(settings.min_band_days_tested).alias("min_band_days_per_route"),
        row(
            permutation_pvalue(routes, "route_id", "imd_decile", "compliance_rate", permutations)
        ).alias("correlation_imd_vs_compliance"),
        row(
            permutation_pvalue(routes, "route_id", "imd_decile", "mean_on_time", permutations)
        ).alias("correlation_imd_vs_on_time"),
        row(deprivation_gap(deciles)).alias("deprivation_gap"),
        row(frequency_confound(facts, dim_route)).alias("frequency_confound"),
        rows(frequency_buckets(facts, dim_route)).alias("compliance_by_trips_per_band"),
        rows(deciles).alias("by_decile"),
    )
    one = facts.sparkSession.range(1)
    return one.select(F.to_json(document).alias("report"))
