"""MLlib training, scoring and interpretation on the feature table."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timepoint.functions.columns import probability_of
from timepoint.operators.features import CATEGORICAL, LABEL, NUMERIC
from timepoint.sources.storage import checkpointed

SEED = 17
#: Rows of a training task: fewer make a fit wait for its tasks, more than the latter grow too large.
TASK_ROWS, MOST_TASK_ROWS = 32_768, 500_000
#: Fits that run side by side; one alone waits for its many short jobs.
FITS = 12


def encode_categoricals() -> list[Estimator]:
    """Index then one-hot encode; labels unseen in training get their own slot."""
    indexed = [f"{c}_index" for c in CATEGORICAL]
    return [
        StringIndexer(inputCols=list(CATEGORICAL), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_onehot" for c in CATEGORICAL]),
    ]


def assemble_scale(scale: bool) -> list:
    """Numeric and one-hot slots in one vector (NaN kept), optionally scaled to unit sd."""
    target = "unscaled" if scale else "features"
    steps: list = [
        VectorAssembler(
            inputCols=[*NUMERIC, *(f"{c}_onehot" for c in CATEGORICAL)],
            outputCol=target,
            handleInvalid="keep",
        )
    ]
    if scale:
        steps.append(StandardScaler(inputCol=target, outputCol="features"))
    return steps


@dataclass(frozen=True)
class Candidate:
    """A classifier and the parameter values to try, as {parameter name: values}.

    ``boosted`` names the parameter that says how many trees are added one after the other: a
    model of few rounds is the beginning of one of more.
    """

    name: str
    estimator: Estimator
    grid: dict[str, Sequence[float]] = field(default_factory=dict)
    scaled: bool = False
    boosted: str | None = None

    def encoding(self) -> Pipeline:
        return Pipeline(stages=[*encode_categoricals(), *assemble_scale(self.scaled)])

    def pipeline(self) -> Pipeline:
        return Pipeline(stages=[*self.encoding().getStages(), self.estimator])

    def param_maps(self) -> list:
        builder = ParamGridBuilder()
        for name, values in self.grid.items():
            builder = builder.addGrid(self.estimator.getParam(name), list(values))
        return builder.build()


def classifiers() -> list[Candidate]:
    """The three compared models with their published 2 x 2 grids and fixed seeds."""
    common = {"labelCol": LABEL, "featuresCol": "features"}
    return [
        Candidate(
            "logistic_regression",
            LogisticRegression(**common),
            {"regParam": (0.0, 0.1), "elasticNetParam": (0.0, 0.5)},
            scaled=True,
        ),
        Candidate(
            "random_forest",
            # rows remember their nodes: the same trees, without walking each from its root per level
            RandomForestClassifier(seed=SEED, cacheNodeIds=True, **common),
            {"numTrees": (50, 100), "maxDepth": (5, 10)},
        ),
        Candidate(
            "gbt",
            GBTClassifier(seed=SEED, **common),
            {"maxIter": (30, 60), "maxDepth": (3, 5)},
            boosted="maxIter",
        ),
    ]


def prepared(features: DataFrame) -> DataFrame:
    """Features ready for MLlib: a missing number becomes NaN, which the vector keeps."""
    return features.select(
        *(F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in NUMERIC),
        *CATEGORICAL,
        F.col(LABEL).cast("int").alias(LABEL),
        *(c for c in ("route_id", "service_date", "is_train") if c in features.columns),
    )


@dataclass(frozen=True)
class Trained:
    name: str
    model: PipelineModel
    auc_by_setting: tuple[float, ...]
    seconds: float


def in_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` pinned in as many partitions as training wants: many fits, each of many short jobs."""
    rows = checkpointed(rows)
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(-(-n // TASK_ROWS), cores), -(-n // MOST_TASK_ROWS))
    if parts == rows.rdd.getNumPartitions():
        return rows
    return checkpointed(rows.repartition(parts))


def _begun(model: Model, rounds: int, rows: DataFrame) -> DataFrame:
    """``rows`` with the margin of the first ``rounds`` trees of a boosted model."""
    margin = F.lit(0.0)
    for k, (tree, weight) in enumerate(zip(model.trees[:rounds], model.treeWeights[:rounds], strict=True)):
        rows = tree.setPredictionCol(f"_tree{k}").transform(rows)
        margin = margin + F.col(f"_tree{k}") * F.lit(float(weight))
    return rows.select(LABEL, margin.alias("margin"))


def _fold_areas(candidate: Candidate, train: DataFrame, held: DataFrame) -> tuple[list[Callable], Callable]:
    """The fits of a fold as calls that give (setting, ROC area on the held rows) pairs, and its end.

    The encoders are fitted once per fold. Settings that differ in the number of boosting rounds
    only are one fit of the most rounds, as its first trees are those of the fewer.
    """
    encoding = candidate.encoding().fit(train)
    seen = encoding.transform(train).select(LABEL, "features").persist()
    unseen = encoding.transform(held).select(LABEL, "features").persist()
    settings = candidate.param_maps()
    groups: dict[tuple, list[int]] = {}
    for i, setting in enumerate(settings):
        rest = tuple(sorted((p.name, v) for p, v in setting.items() if p.name != candidate.boosted))
        groups.setdefault(rest if candidate.boosted else (i,), []).append(i)

    def rounds(i: int) -> int:
        return next((v for p, v in settings[i].items() if p.name == candidate.boosted), 0)

    def area(rows: DataFrame, column: str) -> float:
        return BinaryClassificationEvaluator(
            labelCol=LABEL, rawPredictionCol=column, metricName="areaUnderROC"
        ).evaluate(rows)

    def fit(group: list[int]) -> list:
        most = max(group, key=rounds)
        model = candidate.estimator.fit(seen, settings[most])
        whole = area(model.transform(unseen), "rawPrediction")
        return [
            (i, whole if rounds(i) == rounds(most) else area(_begun(model, rounds(i), unseen), "margin"))
            for i in group
        ]

    return [lambda g=g: fit(g) for g in groups.values()], lambda: (seen.unpersist(), unseen.unpersist())


def cross_validate(train: DataFrame, candidate: Candidate, folds: int = 3) -> Trained:
    """Best setting by ROC area over folds drawn inside the training days only.

    All fits of all folds run side by side: each is a long row of short jobs.
    """
    started = time.monotonic()
    drawn = train.select("*", F.rand(SEED).alias("_drawn"))
    calls, ends = [], []
    for k in range(folds):
        inside = (F.col("_drawn") >= k / folds) & (F.col("_drawn") < (k + 1) / folds)
        fits, end = _fold_areas(candidate, drawn.filter(~inside), drawn.filter(inside))
        calls += fits
        ends.append(end)
    areas: dict[int, list[float]] = {}
    with ThreadPool(min(FITS, len(calls))) as pool:
        for pairs in pool.map(inheritable_thread_target(train.sparkSession)(lambda call: call()), calls, chunksize=1):
            for i, area in pairs:
                areas.setdefault(i, []).append(area)
    for end in ends:
        end()
    means = [sum(areas[i]) / folds for i in sorted(areas)]
    best = max(range(len(means)), key=means.__getitem__)
    model = candidate.pipeline().fit(train, candidate.param_maps()[best])
    return Trained(candidate.name, model, tuple(means), round(time.monotonic() - started, 2))


def score_holdout(trained: Trained, test: DataFrame, model_path: str | None = None) -> DataFrame:
    """Predictions on unseen days as (model, label, score, prediction); saves the pipeline."""
    if model_path is not None:
        trained.model.write().overwrite().save(f"{model_path.rstrip('/')}/{trained.name}")
    scored = trained.model.transform(test)
    return scored.select(
        F.lit(trained.name).alias("model"),
        F.col(LABEL).alias("label"),
        probability_of(F.col("probability")).alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def train_times(spark: SparkSession, runs: Sequence[Trained]) -> DataFrame:
    """Seconds each model took to train (one row per model)."""
    return spark.createDataFrame(
        [(r.name, r.seconds) for r in runs], "model string, train_seconds double"
    )


def encoded(train: DataFrame, candidate: Candidate) -> DataFrame:
    """``train`` with the vector that the candidate learns from; no model is fitted."""
    return candidate.encoding().fit(train).transform(train)


def feature_names(scored: DataFrame, vector: str = "features") -> list[str]:
    """Names of the vector's slots, in slot order, from the column's ML attributes."""
    groups = scored.schema[vector].metadata["ml_attr"]["attrs"].values()
    named = [(attribute["idx"], attribute["name"]) for group in groups for attribute in group]
    return [name for _, name in sorted(named)]


def _per_slot(spark: SparkSession, names: Sequence[str], values, column: str) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    return spark.createDataFrame(rows, f"feature string, {column} double")


def tree_importances(trained: Trained, features: DataFrame) -> DataFrame:
    """Importance per named feature of a fitted tree ensemble."""
    names = feature_names(trained.model.transform(features))
    weights = trained.model.stages[-1].featureImportances.toArray()
    table = _per_slot(features.sparkSession, names, weights, "importance")
    return table.withColumn("model", F.lit(trained.name))


def lr_coefficients(trained: Trained, features: DataFrame) -> DataFrame:
    """Coefficients on unit-sd features, largest magnitude first.

    Scaling keeps slot order but drops slot names, so names come from the unscaled vector.
    """
    names = feature_names(trained.model.transform(features), "unscaled")
    weights = trained.model.stages[-1].coefficients.toArray()
    table = _per_slot(features.sparkSession, names, weights, "coefficient")
    return table.orderBy(F.abs("coefficient").desc(), "feature")


def top_features(importances: DataFrame, k: int = 12) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(k)
