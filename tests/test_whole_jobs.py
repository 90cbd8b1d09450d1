"""Queries that leave nothing of their job out, on tables made here."""

from __future__ import annotations

import oracle
import pytest

from timepoint.operators import models
from timepoint.plans import CHECKS, QUERIES

MADE = {
    "supplier": "select i as s_suppkey, cast(i % 5 as int) as s_nationkey from range(4) r(i)",
    "part": "select i as p_partkey from range(60) r(i)",
    "customer": "select i as c_custkey from range(60) r(i)",
    # one order has no number, so its pings have no route
    "orders": "select case when i <> 7 then i end as o_orderkey from range(360) r(i)",
    "lineitem": """select case when i <> 7 then i end as l_orderkey, (i * 7 + n) % 60 as l_partkey,
        i % 4 as l_suppkey, cast(n as int) as l_linenumber, cast(i * 13 % 50 as double) as l_quantity,
        0.04::double as l_discount, 0.02::double as l_tax from range(360) r(i), range(1, 5) s(n)""",
    "events": """select i as event_id, timestamp '2024-01-01 00:00:00' + to_minutes(i * 37) as ts,
        i % 20 as user_id, 'view' as event_type from range(300) r(i)""",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    made = tmp_path_factory.mktemp("made")
    con = oracle.connect(str(made))
    for name, sql in MADE.items():
        con.execute(f"copy ({sql}) to '{made}/{name}.parquet' (format parquet)")
    return str(made)


def test_every_feature_table_is_assembled(spark, folder):
    """areas, history, disruptions and whole facts were left out."""
    found = QUERIES["assemble_features"](spark, folder)
    got = oracle.spark_table(found)
    assert got[1] and oracle.difference(got, oracle.sql_table(oracle.connect(folder), CHECKS["assemble_features"])) is None
    whole = set(QUERIES["feature_table"](spark, folder).columns)
    assert whole - set(found.columns) == {"is_train", "is_weekend"}
    for column in ("n_stops", "temp_c", "route_hist_ontime_rate", "sched_headway_sd_min", "n_active_disruptions"):
        assert found.filter(f"{column} is not null").count(), column


def test_absent_tables_are_skipped(spark, folder):
    from timepoint.operators.features import assemble_features

    facts = spark.createDataFrame([("R1", 1)], "route_id string, n int")
    assert assemble_features(facts, (None, ["route_id"])).collect() == facts.collect()

def test_holdout_saves_pipelines_and_predictions(spark, folder, monkeypatch):
    """neither was saved, so the comparison never read what a later job would."""
    linear = next(c for c in models.classifiers() if c.name == "logistic_regression")
    short = models.Candidate(linear.name, linear.estimator, {"regParam": (0.1,)}, scaled=True)
    monkeypatch.setattr(models, "classifiers", lambda: [short])
    asked = []
    score = models.score_holdout
    monkeypatch.setattr(
        models, "score_holdout", lambda m, test, path=None: asked.append(path) or score(m, test, path)
    )
    found = QUERIES["score_holdout"](spark, folder).collect()
    assert [r.model for r in found] == [linear.name] and asked[0] is not None
    from pyspark.ml import PipelineModel

    saved = PipelineModel.load(f"{asked[0]}/{linear.name}")
    predictions = spark.read.parquet(f"{asked[0].rsplit('/', 1)[0]}/predictions/{linear.name}")
    assert len(saved.stages) > 1
    assert predictions.count() == found[0].tp + found[0].tn + found[0].fp + found[0].fn > 0


def test_forest_rows_remember_their_nodes(spark):
    """F4 F5 F7 F8: a pass over the rows walked every tree from its root; the trees are the same."""
    forest = next(c for c in models.classifiers() if c.name == "random_forest")
    assert forest.estimator.getCacheNodeIds()
    rows = [
        (*(float((i * (7 + k)) % (5 + k)) for k in range(len(models.NUMERIC))), "Monday", "am_peak", int((i * i) % 7 < 3))
        for i in range(400)
    ]
    train = spark.createDataFrame(rows, [*models.NUMERIC, "day_of_week", "time_band", models.LABEL]).coalesce(1)
    seen = forest.encoding().fit(train).transform(train).cache()
    few = {forest.estimator.numTrees: 5, forest.estimator.maxDepth: 6}
    plain = forest.estimator.copy({forest.estimator.cacheNodeIds: False})
    assert forest.estimator.fit(seen, few).toDebugString.split("\n", 1)[1] == plain.fit(seen, few).toDebugString.split("\n", 1)[1]
