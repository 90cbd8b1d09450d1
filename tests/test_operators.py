from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from timepoint.functions.geo import Grid, haversine_m
from timepoint.operators import (
    disruptions,
    evaluation,
    headway,
    matching,
    operation,
    profile,
    ranking,
    reliability,
    reports,
    spatial,
    statistics,
    warehouse,
)
from timepoint.settings import Settings


def as_set(df):
    return sorted(map(repr, map(tuple, df.collect())))


def skewed_pings(spark, n=3000):
    """Two thirds of all pings belong to one trip, many at one place."""
    rng = random.Random(3)
    pings, sched = [], []
    for trip in range(20):
        for stop in range(12):
            lat, lon = 53.6 + stop * 0.002, -1.6 + (trip % 3) * 0.0005
            sched.append((f"t{trip}", f"s{stop}", stop, lat, lon, 30_000 + stop * 120))
    for i in range(n):
        trip = "t0" if i % 3 else f"t{rng.randrange(20)}"
        stop = rng.randrange(12) if i % 2 else 4
        pings.append(
            (trip, "r", dt.date(2024, 1, 1 + i % 2), 53.6 + stop * 0.002 + rng.uniform(-6e-4, 6e-4),
             -1.6 + rng.uniform(-1e-3, 1e-3), 30_000 + rng.randrange(4000))
        )
    p = spark.createDataFrame(
        pings, "trip_id string, route_id string, service_date date, lat double, lon double, inferred_sec int"
    )
    s = spark.createDataFrame(
        sched,
        "trip_id string, stop_id string, stop_sequence int, stop_lat double, stop_lon double, sched_sec int",
    )
    return p, s


def test_gridded_candidates_equal_plain_join(spark):
    pings, sched = skewed_pings(spark)
    gridded = matching.ping_stop_candidates(pings, sched)
    plain = matching.ping_stop_candidates(pings, sched, gridded=False)
    assert plain.count() > 500
    assert as_set(gridded.select(*sorted(gridded.columns))) == as_set(plain.select(*sorted(plain.columns)))


def test_cells_are_listed_per_stop(spark):
    pings, sched = skewed_pings(spark)
    times = sched.select("trip_id", "stop_id", "stop_sequence", F.lit("08:20:00").alias("arrival_time"))
    # stops of one name lie in one place here
    stops = sched.filter("trip_id = 't0'").select("stop_id", "stop_lat", "stop_lon")
    got = matching.scheduled_candidates(pings, times, stops)
    plain = matching.ping_stop_candidates(pings, matching.sched_with_coords(times, stops), gridded=False)
    assert plain.count() > 500 and got.columns == plain.columns
    assert as_set(got) == as_set(plain)
    listed = matching.sched_in_cells(times, stops, Grid(50.0))._jdf.queryExecution().optimizedPlan()
    lines = listed.toString().splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert join < next(i for i, line in enumerate(lines) if "Generate" in line and "cell_x" in line)


def test_nearest_ping_window_equals_aggregate(spark):
    pings, sched = skewed_pings(spark)
    candidates = matching.ping_stop_candidates(pings, sched)
    window, combined = matching.nearest_ping(candidates), matching.nearest_ping_aggregate(candidates)
    names = sorted(window.columns)
    assert as_set(window.select(*names)) == as_set(combined.select(*names))


def test_match_same_with_and_without_broadcast(spark, tables):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    usual = as_set(tables.delays)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffled = as_set(type(tables)(spark, tables.sf_dir).delays)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert usual == shuffled


def test_latitude_band_contains_radius(spark):
    row = spark.range(1).select(
        haversine_m(F.lit(53.8), F.lit(-1.5), F.lit(53.8 + 50 / 111_194.0), F.lit(-1.5)).alias("d")
    )
    assert row.first()["d"] >= 50


def test_lower_median_of_even_group(spark):
    df = spark.createDataFrame([(x,) for x in (10.0, 1.0, 4.0, 2.0)], "x double")
    assert df.agg(reliability.lower_median("x")).first()[0] == 2.0
    assert df.agg(F.median("x")).first()[0] == 3.0


def test_successive_gaps_ignore_ties_and_breaks(spark):
    events = spark.createDataFrame(
        [("r", "s", t) for t in (0, 0, 600, 600, 1200, 1200 + 181 * 60)], "route_id string, stop_id string, t int"
    )
    got = rows(headway.successive_gaps(events, "t").select("headway_min"))
    assert got == [(10.0,), (10.0,)]


def shapes(spark):
    concave = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]
    outer = [(5.0, 0.0), (9.0, 0.0), (9.0, 4.0), (5.0, 4.0), (5.0, 0.0)]
    hole = [(6.0, 1.0), (8.0, 1.0), (8.0, 3.0), (6.0, 3.0), (6.0, 1.0)]
    overlap = [(3.0, -1.0), (6.5, -1.0), (6.5, 2.0), (3.0, 2.0), (3.0, -1.0)]
    schema = "lsoa_code string, rings array<array<struct<x: double, y: double>>>"
    return spark.createDataFrame(
        [("concave", [concave]), ("ring", [outer, hole]), ("overlap", [overlap])], schema
    )


def every_stop_against_every_area(stops, areas):
    shaped = areas.select("lsoa_code", spatial.polygon_edges(F.col("rings")).alias("edges"))
    inside = spatial.strictly_inside(F.col("stop_lon"), F.col("stop_lat"), F.col("edges"))
    return stops.join(shaped, inside, "left").select("stop_id", "lsoa_code")


def test_spatial_join_equals_brute_force(spark):
    rng = random.Random(1)
    points = [(f"p{i}", rng.uniform(-1, 5), rng.uniform(-1, 10)) for i in range(400)]
    points += [("corner", 0.0, 0.0), ("edge", 0.0, 2.0), ("notch", 1.0, 2.0), ("hole", 2.0, 7.0), ("in", 0.5, 0.5)]
    stops = spark.createDataFrame(points, "stop_id string, stop_lat double, stop_lon double")
    fast = spatial.point_in_polygon(stops, shapes(spark))
    slow = every_stop_against_every_area(stops, shapes(spark))
    assert as_set(fast.select("stop_id", "lsoa_code")) == as_set(slow)
    found = {}
    for stop, area in rows(fast):
        found.setdefault(stop, set()).add(area)
    assert found["corner"] == {None} and found["edge"] == {None}
    assert found["notch"] == {None} and found["hole"] == {None} and found["in"] == {"concave"}
    assert any(len(a) == 2 for a in found.values())


def test_spatial_join_without_areas(spark):
    stops = spark.createDataFrame([("s", 1.0, 1.0)], "stop_id string, stop_lat double, stop_lon double")
    assert rows(spatial.point_in_polygon(stops, shapes(spark).filter("false"))) == [("s", None)]


def test_average_rank_matches_pandas(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 40, 500).tolist() + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int").repartition(7)
    got = {r["i"]: r["rank"] for r in ranking.average_rank(df, "v").collect()}
    expected = pd.Series(values, dtype="float").rank()
    assert got.pop(500) is None
    assert [got[i] for i in range(500)] == expected[:500].tolist()


@pytest.mark.parametrize("hot", [0.0, 0.35, 0.9])
def test_a_hot_value_is_ranked_in_many_partitions(spark, hot):
    rng = np.random.default_rng(5)
    values = np.where(rng.random(900) < hot, 7.0, rng.integers(-20, 20, 900) / 2.0).tolist()
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(values)], "i int, v double, _place string").drop("_place")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranking.average_rank(df.unionByName(df.limit(0)), "v")
        got = {r["i"]: r["rank"] for r in ranked.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [got[i] for i in range(900)] == pd.Series(values).rank().tolist()
    # rows are joined with one row per partition, never on their value
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert all("_part" in line for line in joins) and joins


def test_running_totals_across_partitions(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("k"), F.lit(1).alias("n")).repartition(9)
    got = ranking.running_totals(df, [F.col("id").desc()], ["n"], ["k"])
    want = {}
    for i in sorted(range(1000), reverse=True):
        want[i] = want.get(i + 3, 0) + 1
    assert {r["id"]: r["cum_n"] for r in got.collect()} == want


def test_spearman_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x, y = rng.integers(1, 11, 200), rng.normal(size=200).round(1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(x, y)], "x int, y double")
    expected = np.corrcoef(pd.Series(x).rank(), pd.Series(y).rank())[0, 1]
    pairs = statistics.spearman_pairs(df, {"a": ("x", "y"), "b": ("y", "y")})
    got = {r["pair"]: r["rho"] for r in pairs.collect()}
    assert got["a"] == pytest.approx(expected, abs=1e-12) and got["b"] == pytest.approx(1.0)


def plain_shuffle(slot, replicate, n, seed):
    prime, (a, b) = 2**31 - 1, statistics.shuffle_sides(n)
    begin = (((replicate * 1_000_003 + seed * 7_919 + 12_345) ** 2 % prime) + replicate) ** 2 % prime
    keys = [(begin + j * 362_437) ** 2 % prime for j in range(statistics.ROUNDS + 1)]
    while True:
        left, right = divmod(slot, b)
        for j in range(statistics.ROUNDS):
            mixed = (((right + 1) * keys[j] + keys[j + 1]) % prime) >> 7
            left, right = right, (left + mixed) % (b if j % 2 else a)
        slot = left * b + right
        if slot < n:
            return slot


def test_permutation_test_matches_brute_force(spark):
    data = [(f"r{i}", i % 5, (i * 7) % 11 / 10) for i in range(14)]
    df = spark.createDataFrame(data, "u string, x int, y double")
    got = statistics.permutation_pvalue(df, "u", "x", "y", permutations=60, seed=3).first()
    data.sort()
    rx = pd.Series([d[1] for d in data]).rank().to_numpy()
    ry = pd.Series([d[2] for d in data]).rank().to_numpy()
    rho, hits = np.corrcoef(rx, ry)[0, 1], 0
    for rep in range(1, 61):
        drawn = rx[[plain_shuffle(slot, rep, 14, 3) for slot in range(14)]]
        hits += round(abs(np.corrcoef(drawn, ry)[0, 1]), 12) >= round(abs(rho), 12)
    assert got["p_value_permutation"] == round(hits / 60, 5)
    assert got["spearman_rho"] == round(rho, 4) and got["n_routes"] == 14


def test_shuffles_are_bijections_and_fair(spark):
    for n in (1, 2, 7, 100, 1009):
        for rep in (1, 2, 10_000):
            assert sorted(plain_shuffle(k, rep, n, 11) for k in range(n)) == list(range(n))
    # every slot goes everywhere about as often, and pairs of slots do so together
    places = np.array([[plain_shuffle(k, rep, 7, 11) for k in range(7)] for rep in range(1, 4201)])
    for k in range(7):
        assert np.abs(np.bincount(places[:, k], minlength=7) - 600).max() < 110
    pairs = np.bincount(places[:, 0] * 7 + places[:, 3], minlength=49)
    assert np.abs(pairs[pairs > 0] - 100).max() < 45 and (pairs > 0).sum() == 42
    for n in (100, 103):  # the second has slots beyond n to walk through
        slots = spark.range(n).select(F.col("id").alias("slot"), F.lit(5).cast("long").alias("replicate"))
        got = statistics.shuffled_slot(slots.coalesce(1), n, 11)
        assert [r.slot for r in got.collect()] == [plain_shuffle(k, 5, n, 11) for k in range(n)]


def test_permutations_of_many_units_join_instead(spark, monkeypatch):
    df = spark.createDataFrame([(f"r{i}", i % 5, (i * 7) % 11 / 10) for i in range(14)], "u string, x int, y double")
    sent = statistics.permutation_pvalue(df, "u", "x", "y", permutations=40).first()
    monkeypatch.setattr(statistics, "SENT_UNITS", 3)
    joined = statistics.permutation_pvalue(df, "u", "x", "y", permutations=40)
    assert joined.first() == sent
    assert "Window" not in joined._jdf.queryExecution().optimizedPlan().toString()


def predictions(spark, labels, scores, model="m"):
    data = [(model, l, s, int(s >= 0.5)) for l, s in zip(labels, scores)]
    return spark.createDataFrame(data, "model string, label int, score double, prediction int")


def test_roc_separable(spark):
    p = predictions(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])
    points = rows(evaluation.roc_points(p).select("fpr", "tpr"))
    assert (0.0, 1.0) in points and (1.0, 1.0) in points and (0.0, 0.0) in points
    first = evaluation.pr_points(p).orderBy(F.desc("score")).first()
    assert first["precision"] == 1.0


def test_roc_mixed_runs_corner_to_corner(spark):
    p = predictions(spark, [0, 1, 0, 1], [0.5, 0.4, 0.3, 0.2])
    points = rows(evaluation.roc_points(p).orderBy(F.desc_nulls_first("score")).select("fpr", "tpr"))
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)


def test_areas_equal_mllib_without_downsampling(spark):
    rng = np.random.default_rng(8)
    labels = rng.integers(0, 2, 400)
    scores = (labels * 0.3 + rng.random(400)).round(2) / 1.3
    p = predictions(spark, labels.tolist(), scores.tolist())
    got = evaluation.areas_under_curves(p).first()
    for name, metric in (("roc_auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
        mllib = BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol="score", metricName=metric, numBins=0
        ).evaluate(p.withColumn("label", F.col("label").cast("double")))
        assert got[name] == pytest.approx(mllib, abs=1e-12)


def test_confusion_rates_with_empty_denominators(spark):
    p = predictions(spark, [0, 0], [0.1, 0.2])
    got = evaluation.confusion_metrics(evaluation.confusion_counts(p)).first()
    assert (got["tp"], got["tn"], got["specificity"]) == (0, 2, 1.0)
    assert got["positive_recall"] == got["positive_precision"] == got["false_negative_rate"] == 0.0
    matrix = rows(evaluation.confusion_matrix(p).select("label", "prediction", "n"), "label", "prediction")
    assert matrix == [(0, 0, 2), (0, 1, 0), (1, 0, 0), (1, 1, 0)]


def test_best_threshold_tie_goes_low(spark):
    p = predictions(spark, [0, 1], [0.05, 0.95])
    sweep = evaluation.threshold_sweep(p)
    assert sweep.count() == 17
    assert evaluation.best_threshold(sweep).first()["threshold"] == 0.10


def test_calibration_bins_are_right_closed(spark):
    p = predictions(spark, [0, 1, 1], [0.0, 0.1, 0.11])
    got = rows(evaluation.calibration_curve(p).select("bin", "n"), "bin")
    assert got == [(1, 2), (2, 1)]


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(9)
    x = (rng.normal(3, 8, 2000)).round(3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = profile.histogram(df, "x", 20, (-10.0, 20.0)).orderBy("bin").collect()
    counts, edges = np.histogram(x.clip(-10, 20), bins=20)
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["bin_low"] for r in got] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_constant_and_empty(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    got = profile.histogram(df, "x", 4)
    assert got.agg(F.sum("n"), F.min("bin_low"), F.max("bin_high")).first()[:] == (2, 4.5, 5.5)
    assert profile.histogram(df.filter("false"), "x", 4).count() == 0


def test_moments_match_definitions(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 4.0, 10.0)], "x double")
    got = profile.moments(df, "x").first()
    assert got["median"] == 2.0 and got["skewness"] == pytest.approx(0.848, abs=1e-3)


def test_approx_cardinality_is_close(spark):
    df = spark.range(20_000).select((F.col("id") % 7000).alias("k"))
    got = profile.approx_cardinality(df, ["k"], rsd=0.02).first()["k"]
    assert abs(got - 7000) / 7000 < 0.06


def test_correlation_skips_missing_pairs(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 7.0, 5.0)], "a double, b double, c double"
    )
    got = {(r["a"], r["b"]): r["correlation"] for r in profile.correlation_matrix(df, "abc").collect()}
    frame = pd.DataFrame({"a": [1.0, 2, 3, 4], "b": [2.0, 4, None, 7]}).corr()
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(frame.loc["a", "b"])
    assert got[("a", "c")] is None and len(got) == 9


def test_sensitivity_equals_one_band_at_a_time(spark, tables):
    got = {r["window"]: r for r in reliability.sensitivity_windows(tables.trip_facts).collect()}
    for minutes in (2, 3, 5):
        bands = (
            tables.trip_facts.filter("time_band is not null")
            .groupBy("route_id", "service_date", "time_band")
            .agg(F.avg(f"on_time_{minutes}_{minutes}").alias("p"))
        )
        share = bands.agg(F.avg((F.col("p") >= 0.85).cast("int"))).first()[0]
        assert got[f"+/-{minutes} min"]["compliant_share"] == round(share, 4)


def test_active_services_respects_flags_and_range(spark):
    week = ", ".join(f"{d} int" for d in ("monday tuesday wednesday thursday friday saturday sunday").split())
    cal = spark.createDataFrame(
        [("wk", 1, 1, 1, 1, 1, 0, 0, 20240101, 20240103), ("we", 0, 0, 0, 0, 0, 1, 1, 20240101, 20241231)],
        f"service_id string, {week}, start_date int, end_date int",
    )
    dates = [dt.date(2024, 1, d) for d in range(1, 8)]
    got = rows(operation.active_services(cal, dates), "service_id", "service_date")
    assert got == [("we", dates[5]), ("we", dates[6]), ("wk", dates[0]), ("wk", dates[1]), ("wk", dates[2])]


def test_operation_total_without_trips(spark):
    empty = spark.createDataFrame([], "service_date date, trip_id string, route_id string, confirmed int")
    assert rows(operation.operation_floor_total(empty)) == [(0, 0, None)]


def test_open_ended_notices(spark):
    notices = spark.createDataFrame(
        [("a", "2024-01-03T00:00:00Z", None), ("b", "2024-01-01", "2024-01-02T23:00:00Z"), ("c", "2024-01-05", "2024-01-01")],
        "situation_id string, validity_start string, validity_end string",
    )
    dates = [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    got = disruptions.validity_range_join(disruptions.notice_dates(notices), dates)
    assert rows(got.groupBy("situation_id").count(), "situation_id") == [("a", 2), ("b", 2)]


def test_upsert_last_wins(spark):
    schema = "k int, v string, o int"
    old = spark.createDataFrame([(1, "old", 9), (2, "kept", 1)], schema)
    new = spark.createDataFrame([(1, "mid", 1), (1, "last", 2), (3, "added", 1)], schema)
    got = warehouse.upsert_last_wins(old, new, ["k"], ["o"]).select("k", "v")
    assert rows(got, "k") == [(1, "last"), (2, "kept"), (3, "added")]


def test_key_violations(spark):
    tables = {
        "dim_route": spark.createDataFrame([("r1",), ("r1",)], "route_id string"),
        "fact_route_band_day": spark.createDataFrame(
            [("r1", "d", "b"), ("r2", "d", "b"), (None, "d", "b")],
            "route_id string, service_date string, time_band string",
        ),
    }
    assert rows(warehouse.pk_violations(tables), "table_name")[0] == ("dim_route", 1, 1)
    assert rows(warehouse.fk_violations(tables)) == [("fact_route_band_day", "route_id", 1)]


def test_compliance_for_band_binds_its_value(spark):
    facts = spark.createDataFrame([("Monday", "am_peak", 0.5)], "day_of_week string, time_band string, pct_on_time double")
    assert reports.compliance_for_band(spark, facts, "am_peak").count() == 1
    assert reports.compliance_for_band(spark, facts, "x' or '1'='1").count() == 0


def test_deprivation_gap_weights_by_days(spark):
    by_decile = spark.createDataFrame(
        [(1, 0.5, 3), (3, 0.1, 1), (5, 0.9, 9), (9, 0.8, 2)], "imd_decile int, compliance_rate double, band_days int"
    )
    assert rows(statistics.deprivation_gap(by_decile)) == [(0.4, 0.8, 40.0)]


def test_empty_facts_give_zero_shares(spark):
    empty = spark.createDataFrame([], "compliant int, pct_on_time double")
    assert rows(reliability.compliance_share(empty)) == [(0, 0, 0.0)]
    assert rows(evaluation.majority_baseline(empty)) == [(0.0, 0)]


@pytest.mark.parametrize("few", [20, 100_000])
def test_exact_quantiles_for_any_rounds(spark, few):
    rng = np.random.default_rng(1)
    tables = {
        "wide": np.concatenate([rng.normal(0, 1, 700), rng.normal(0, 1, 300) * 1e300, [5e-324, -1e-300]]),
        "hot": np.where(rng.random(1500) < 0.4, 2.5, rng.integers(0, 9, 1500) * 1.0),
        "two": np.array([1.0, 2.0]),
    }
    for values in tables.values():
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
        for fraction in (0.0, 0.013, 0.5, 1.0):
            got = profile.exact_quantile(df, "v", fraction, few=few).first()[0]
            assert got == pytest.approx(np.quantile(values, fraction), rel=1e-12)
        lower = profile.exact_quantile(df, "v", 0.37, "lower", few=few).first()[0]
        assert lower == np.quantile(values, 0.37, method="lower")


def test_quantile_of_nothing_and_of_whole_numbers(spark):
    none = spark.createDataFrame([], "v double")
    assert profile.exact_quantile(none, "v").first()[0] is None
    whole = spark.range(10_001).select(F.col("id").alias("v"))
    assert profile.exact_quantile(whole, "v", 0.3, "lower", few=50).first()[0] == 3000
    left, below, total = profile._narrowed(whole.select(F.col("v").alias("x")), 0.5, 50)
    assert left.count() <= 50 and total == 10_001 and 4950 <= below <= 5000
