from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from timepoint.operators import evaluation, models
from timepoint.operators.features import LABEL, NUMERIC, PRECURSORS, leakage_checks
from timepoint.plans.report import feature_rows
from timepoint.sources.storage import checkpointed


@pytest.fixture(scope="module")
def features(tables):
    return checkpointed(feature_rows(tables))


def test_features_are_leakage_safe(features):
    assert {r["rule"]: r["violations"] for r in leakage_checks(features).collect()} == {
        "dates_ordered": 0, "history_is_train_only": 0, "outcome_not_a_feature": 0,
    }
    assert not set(NUMERIC) & {LABEL, *PRECURSORS}


def test_leak_is_reported(features):
    leaky = features.withColumn("route_hist_ontime_rate", F.col("pct_on_time"))
    got = {r["rule"]: r["violations"] for r in leakage_checks(leaky).collect()}
    assert got["history_is_train_only"] > 0


def test_train_score_and_interpret(spark, features, tmp_path):
    rows = models.prepared(features)
    train, test = rows.filter("is_train = 1"), rows.filter("is_train = 0")
    by_name = {c.name: c for c in models.classifiers()}
    assert all(len(c.param_maps()) == 4 for c in by_name.values())

    linear = models.Candidate(
        "logistic_regression", by_name["logistic_regression"].estimator, {"regParam": (0.0, 0.1)}, scaled=True
    )
    best = models.cross_validate(train, linear, folds=2)
    assert len(best.auc_by_setting) == 2
    scored = models.score_holdout(best, test, str(tmp_path))
    assert scored.count() == test.count()
    assert scored.filter("score < 0 or score > 1").count() == 0
    assert (tmp_path / "logistic_regression").is_dir()
    metrics = evaluation.f1_per_second(
        evaluation.model_comparison(scored), models.train_times(spark, [best])
    ).first()
    assert metrics["train_seconds"] == best.seconds and metrics["f1_per_sec"] is not None

    weights = models.lr_coefficients(best, train).collect()
    sizes = [abs(r["coefficient"]) for r in weights]
    assert sizes == sorted(sizes, reverse=True) and "n_trips" in {r["feature"] for r in weights}

    forest = by_name["random_forest"]
    fitted = models.Trained("random_forest", forest.pipeline().fit(train), (), 0.0)
    importances = models.tree_importances(fitted, train)
    assert importances.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert models.top_features(importances, 5).count() == 5


def test_fits_share_encoders_and_boosting_rounds(spark):
    """Areas are those of Spark's own cross-validation, from fewer fits."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    days, bands = ("Monday", "Sunday"), ("am_peak", "evening")
    made = [
        (*(float((i * (7 + k)) % (5 + k)) for k in range(len(NUMERIC))), days[i % 2], bands[i % 3 % 2], int((i * i) % 7 < 3))
        for i in range(300)
    ]
    train = models.in_tasks(spark.createDataFrame(made, [*NUMERIC, "day_of_week", "time_band", LABEL]).repartition(6))
    assert train.rdd.getNumPartitions() == 1  # few rows are one task, whatever they came in

    class Counted(GBTClassifier):
        fits = 0

        def fit(self, dataset, params=None):
            Counted.fits += 1
            return super().fit(dataset, params)

    tree = Counted(seed=models.SEED, labelCol=LABEL, featuresCol="features")
    grid = {"maxIter": (2, 4), "maxDepth": (1, 2)}
    candidate = models.Candidate("gbt", tree, grid, boosted="maxIter")
    found = models.cross_validate(train, candidate, folds=2)
    assert Counted.fits == 2 * 2 + 1  # a fit per fold and depth, and the chosen one
    plain = CrossValidator(
        estimator=candidate.pipeline(), estimatorParamMaps=candidate.param_maps(), numFolds=2, seed=models.SEED,
        evaluator=BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC"),
    ).fit(train)
    assert found.auc_by_setting == pytest.approx(tuple(plain.avgMetrics), abs=1e-9)
    assert found.model.stages[-1].getNumTrees == plain.bestModel.stages[-1].getNumTrees


def test_slot_names_need_no_search(spark, tables, monkeypatch):
    from timepoint.plans import QUERIES

    def none(*_, **__):
        raise AssertionError("a model was searched")

    monkeypatch.setattr(models, "cross_validate", none)
    names = [r.feature for r in QUERIES["feature_names"](spark, tables.sf_dir).orderBy("slot").collect()]
    assert names[: len(NUMERIC)] == list(NUMERIC) and len(names) > len(NUMERIC)
