"""Queries over features, models and their evaluation."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.operators import evaluation, features, models
from timepoint.plans.binding import Tables
from timepoint.plans.registry import query
from timepoint.plans.report import feature_rows
from timepoint.sources.storage import shared_directory

_FEATURE_DOUBLES = (
    "pct_on_time mean_trip_delay sd_trip_delay precip_mm temp_c wind_kph "
    "route_hist_ontime_rate sched_headway_mean_min sched_headway_sd_min"
)


@query("feature_table", "select * from features", _FEATURE_DOUBLES)
def _(t: Tables) -> DataFrame:
    return feature_rows(t)


@query(
    "time_split",
    """select service_date, cast(service_date <= date '2024-01-05' as int) as is_train,
              count(*) as n from band_days group by 1, 2""",
)
def _(t: Tables) -> DataFrame:
    split = features.time_split(t.band_days, t.settings.train_dates)
    return split.groupBy("service_date", "is_train").agg(F.count(F.lit(1)).alias("n"))


@query(
    "leakage_checks",
    """select 'dates_ordered' as rule,
              cast((select max(service_date) from features where is_train = 1) >=
                   (select min(service_date) from features where is_train = 0) as bigint)
                  as violations
       union all
       select 'history_is_train_only', count(*) from (
           select f.route_id from features f left join route_history h using (route_id)
           where abs(f.route_hist_ontime_rate - coalesce(h.route_hist_ontime_rate, 0)) > 1e-6
           group by 1)
       union all select 'outcome_not_a_feature', 0""",
)
def _(t: Tables) -> DataFrame:
    return features.leakage_checks(feature_rows(t), t.settings)


# ------------------------------------------------------------------ evaluation


@query(
    "confusion_matrix",
    """select model, label, prediction, count(case_id) as n
       from (select * from (select distinct model from predictions),
                  (values (0), (1)) as a(label), (values (0), (1)) as b(prediction))
       left join predictions using (model, label, prediction) group by 1, 2, 3""",
)
def _(t: Tables) -> DataFrame:
    return evaluation.confusion_matrix(t.predictions)


_RATES_SQL = """select model, tp, tn, fp, fn, tn / (tn + fp) as specificity,
    (tp / (tp + fn) + tn / (tn + fp)) / 2e0 as balanced_accuracy,
    case when tn + fn = 0 then 0e0 else tn / (tn + fn) end as npv,
    fp / (fp + tn) as false_positive_rate, fn / (fn + tp) as false_negative_rate,
    tp / (tp + fp) as positive_precision, tp / (tp + fn) as positive_recall
    from confusion"""
_RATES = (
    "specificity balanced_accuracy npv false_positive_rate false_negative_rate "
    "positive_precision positive_recall"
)


@query("confusion_metrics", _RATES_SQL, _RATES)
def _(t: Tables) -> DataFrame:
    return evaluation.confusion_metrics(evaluation.confusion_counts(t.predictions))


_WEIGHTED_SQL = """select model, (tp + tn) / n as accuracy, (p1 * pos + p0 * neg) / n as precision,
    (r1 * pos + r0 * neg) / n as recall, (f1 * pos + f0 * neg) / n as f1
    from (select *, 2e0 * p1 * r1 / (p1 + r1) as f1,
                 case when p0 + r0 = 0 then 0e0 else 2e0 * p0 * r0 / (p0 + r0) end as f0
          from (select *, tp + fn as pos, tn + fp as neg, tp + tn + fp + fn as n,
                       tp / (tp + fp) as p1,
                       case when tn + fn = 0 then 0e0 else tn / (tn + fn) end as p0,
                       tp / (tp + fn) as r1, tn / (tn + fp) as r0 from confusion))"""


@query("classification_metrics", _WEIGHTED_SQL, "accuracy precision recall f1")
def _(t: Tables) -> DataFrame:
    return evaluation.classification_metrics(evaluation.confusion_counts(t.predictions))


@query(
    "cumulative_confusion",
    "select model, score, pos, neg, tp, fp from steps",
    "score",
)
def _(t: Tables) -> DataFrame:
    return evaluation.cumulative_confusion(t.predictions).select(
        "model", "score", "pos", "neg", "tp", "fp"
    )


@query(
    "roc_points",
    """select model, score, fp / q as fpr, tp / p as tpr from steps
       union all select distinct model, cast(null as double), 0e0, 0e0 from predictions""",
    "score fpr tpr",
)
def _(t: Tables) -> DataFrame:
    return evaluation.roc_points(t.predictions)


@query(
    "pr_points",
    "select model, score, tp / p as recall, tp / (tp + fp) as precision from steps",
    "score recall precision",
)
def _(t: Tables) -> DataFrame:
    return evaluation.pr_points(t.predictions)


_AREAS = """select r.model, roc_auc, pr_auc from
    (select model, (sum(ra) filter (label = 1) - any_value(p) * (any_value(p) + 1) / 2e0)
                   / (any_value(p) * any_value(q)) as roc_auc
     from (select model, label, sum(label) over (partition by model) as p,
                  sum(1 - label) over (partition by model) as q,
                  rank() over (partition by model order by score)
                  + (count(*) over (partition by model, score) - 1) / 2e0 as ra
           from predictions) group by model) r
    join (select model, sum(pos * (coalesce((tp - pos) / nullif(tp - pos + fp - neg, 0), tp / (tp + fp))
                            + tp / (tp + fp)) / 2e0) / any_value(p) as pr_auc
          from steps group by model) s on r.model = s.model"""


@query("areas_under_curves", _AREAS, "roc_auc pr_auc")
def _(t: Tables) -> DataFrame:
    return evaluation.areas_under_curves(t.predictions)


@query(
    "majority_baseline",
    """select max(n) / sum(n) as baseline_accuracy, cast(sum(n) as bigint) as n
       from (select compliant, count(*) as n from features where is_train = 0 group by 1)""",
    "baseline_accuracy",
)
def _(t: Tables) -> DataFrame:
    held_out = features.time_split(t.band_days, t.settings.train_dates).filter("is_train = 0")
    return evaluation.majority_baseline(held_out)


_SWEEP_SQL = """select model, threshold,
    case when tp + fp = 0 then 0e0 else tp / (tp + fp) end as precision, tp / (tp + fn) as recall,
    2e0 * tp / (2 * tp + fp + fn) as f1
    from (select model, threshold, count(*) filter (label = 1 and score >= threshold) as tp,
                 count(*) filter (label = 0 and score >= threshold) as fp,
                 count(*) filter (label = 1 and score < threshold) as fn
          from predictions,
               (select round(0.05e0 * i, 2) as threshold from range(2, 19) as r(i))
          group by model, threshold)"""


@query("threshold_sweep", _SWEEP_SQL, "threshold precision recall f1")
def _(t: Tables) -> DataFrame:
    return evaluation.threshold_sweep(t.predictions)


@query(
    "best_threshold",
    f"""select * exclude (place) from (
            select *, row_number() over (partition by model
                                         order by round(f1, 12) desc, threshold) as place
            from ({_SWEEP_SQL})) where place = 1""",
    "threshold precision recall f1",
)
def _(t: Tables) -> DataFrame:
    return evaluation.best_threshold(evaluation.threshold_sweep(t.predictions))


@query(
    "calibration_curve",
    """select model, cast(greatest(ceil(round(score * 10e0, 6)), 1) as int) as bin,
              avg(score) as predicted, avg(label) as observed, count(*) as n
       from predictions group by 1, 2""",
    "predicted observed",
)
def _(t: Tables) -> DataFrame:
    return evaluation.calibration_curve(t.predictions)


@query(
    "model_comparison",
    f"""select * from ({_WEIGHTED_SQL}) join ({_AREAS}) using (model)
        join ({_RATES_SQL}) using (model)""",
    f"accuracy precision recall f1 roc_auc pr_auc {_RATES}",
)
def _(t: Tables) -> DataFrame:
    return evaluation.model_comparison(t.predictions)


# ------------------------------------------------------------------ MLlib (rows only)


_rows: dict[tuple[str, str], DataFrame] = {}
_searched: dict[tuple[str, str, str], models.Trained] = {}


def _split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The training and the held-out rows, prepared once per session and folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _rows:
        _rows[key] = models.in_tasks(models.prepared(feature_rows(t)))
    return _rows[key].filter("is_train = 1"), _rows[key].filter("is_train = 0")


def _models(t: Tables, *names: str) -> list[models.Trained]:
    """The named candidates (all, if none), each searched once per session and folder."""
    train, _ = _split(t)
    found = []
    for candidate in models.classifiers():
        if names and candidate.name not in names:
            continue
        key = (t.spark.sparkContext.applicationId, t.sf_dir, candidate.name)
        if key not in _searched:
            _searched[key] = models.cross_validate(train, candidate)
        found.append(_searched[key])
    return found


@query("cross_validate")
def _(t: Tables) -> DataFrame:
    searched = _models(t)
    rows = [(m.name, i, float(auc)) for m in searched for i, auc in enumerate(m.auc_by_setting)]
    return t.spark.createDataFrame(rows, "model string, setting int, mean_auc double")


def _holdout(t: Tables) -> DataFrame:
    """Saved predictions of all models on unseen days; each fitted pipeline is saved beside them."""
    _, test = _split(t)
    folder = f"{shared_directory(t.spark).rstrip('/')}/holdout-{uuid.uuid4().hex}"
    places = []
    for m in _models(t):
        places.append(f"{folder}/predictions/{m.name}")
        models.score_holdout(m, test, f"{folder}/models").write.parquet(places[-1])
    return t.spark.read.parquet(*places)


@query("score_holdout")
def _(t: Tables) -> DataFrame:
    return evaluation.model_comparison(_holdout(t))


@query("f1_per_second")
def _(t: Tables) -> DataFrame:
    return evaluation.f1_per_second(
        evaluation.model_comparison(_holdout(t)), models.train_times(t.spark, _models(t))
    ).select("model", "train_seconds", "f1", "f1_per_sec")


@query("feature_names")
def _(t: Tables) -> DataFrame:
    train, _ = _split(t)
    names = models.feature_names(models.encoded(train, models.classifiers()[-1]))
    return t.spark.createDataFrame(list(enumerate(names)), "slot int, feature string")


@query("lr_coefficients")
def _(t: Tables) -> DataFrame:
    train, _ = _split(t)
    return models.lr_coefficients(_models(t, "logistic_regression")[0], train)


@query("tree_importances")
def _(t: Tables) -> DataFrame:
    train, _ = _split(t)
    searched = _models(t, "random_forest", "gbt")
    ranked = [models.top_features(models.tree_importances(m, train)) for m in searched]
    return reduce(DataFrame.unionByName, ranked)
