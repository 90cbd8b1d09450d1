"""Binary classifier evaluation on predictions (model, label, score, prediction).

All models are evaluated together: ``model`` is a grouping column, so comparing more models
adds groups, not jobs. Curves, areas and sweeps start from counts per distinct score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timepoint.functions.buckets import bucket_right_closed
from timepoint.operators.ranking import running_totals

# 0.10, 0.15 ... 0.90.
THRESHOLDS = tuple(round(0.05 * step, 2) for step in range(2, 19))


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 when the denominator is empty."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Counts of all four (label, prediction) cells per model, zeros included."""
    cells = F.array(
        *(
            F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"))
            for a in (0, 1)
            for b in (0, 1)
        )
    )
    counts = predictions.groupBy("model", "label", F.col("prediction").cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spine = counts.select("model").distinct().select("model", F.inline(cells))
    return spine.join(counts, ["model", "label", "prediction"], "left").fillna(0, ["n"])


def confusion_counts(predictions: DataFrame) -> DataFrame:
    """tp, tn, fp, fn per model."""
    positive, flagged = F.col("label") == 1, F.col("prediction") == 1
    return predictions.groupBy("model").agg(
        F.count_if(positive & flagged).alias("tp"),
        F.count_if(~positive & ~flagged).alias("tn"),
        F.count_if(~positive & flagged).alias("fp"),
        F.count_if(positive & ~flagged).alias("fn"),
    )


def confusion_metrics(counts: DataFrame) -> DataFrame:
    """Rates of the positive class; 0.0 where a denominator is empty."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    recall, specificity = _share(tp, tp + fn), _share(tn, tn + fp)
    return counts.select(
        "*",
        specificity.alias("specificity"),
        ((recall + specificity) / F.lit(2.0)).alias("balanced_accuracy"),
        _share(tn, tn + fn).alias("npv"),
        _share(fp, fp + tn).alias("false_positive_rate"),
        _share(fn, fn + tp).alias("false_negative_rate"),
        _share(tp, tp + fp).alias("positive_precision"),
        recall.alias("positive_recall"),
    )


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1 from the four counts."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    total, pos, neg = tp + tn + fp + fn, tp + fn, tn + fp

    def f1(p: Column, r: Column) -> Column:
        return _share(p * r * F.lit(2.0), p + r)

    prec1, prec0 = _share(tp, tp + fp), _share(tn, tn + fn)
    rec1, rec0 = _share(tp, pos), _share(tn, neg)

    def weighted(one: Column, zero: Column) -> Column:
        return _share(one * pos + zero * neg, total)

    return counts.select(
        "model",
        _share(tp + tn, total).alias("accuracy"),
        weighted(prec1, prec0).alias("precision"),
        weighted(rec1, rec0).alias("recall"),
        weighted(f1(prec1, rec1), f1(prec0, rec0)).alias("f1"),
    )


def score_counts(predictions: DataFrame) -> DataFrame:
    """Positives and negatives per distinct (model, score), combined map-side."""
    return predictions.groupBy("model", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") == 0).alias("neg"),
    )


def cumulative_confusion(predictions: DataFrame) -> DataFrame:
    """True and false positives when everything scored at or above each score is flagged."""
    steps = running_totals(
        score_counts(predictions), [F.col("score").desc()], ["pos", "neg"], ["model"]
    )
    return steps.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})


def _class_totals(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model").agg(
        F.count_if(F.col("label") == 1).alias("all_pos"),
        F.count_if(F.col("label") == 0).alias("all_neg"),
    )


def roc_points(predictions: DataFrame) -> DataFrame:
    """ROC curve from (0, 0), one point per distinct score; the origin has no score."""
    curve = cumulative_confusion(predictions).join(_class_totals(predictions), "model")
    points = curve.select(
        "model",
        "score",
        _share(F.col("fp"), F.col("all_neg")).alias("fpr"),
        _share(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    origin = predictions.select("model").distinct().select(
        "model",
        F.lit(None).cast("double").alias("score"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return origin.unionByName(points)


def pr_points(predictions: DataFrame) -> DataFrame:
    """Precision-recall points, one per distinct score."""
    curve = cumulative_confusion(predictions).join(_class_totals(predictions), "model")
    return curve.select(
        "model",
        "score",
        _share(F.col("tp"), F.col("all_pos")).alias("recall"),
        F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(1.0)).alias("precision"),
    )


def areas_under_curves(predictions: DataFrame) -> DataFrame:
    """Exact ROC area (ties count half) and step-free PR area per model.

    Every distinct score adds one trapezium; both areas come from a single pass over the
    cumulative counts. The PR curve starts at (0, precision of the first point).
    """
    curve = cumulative_confusion(predictions)
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    here = tp / (tp + fp)
    tp0, fp0 = tp - pos, fp - neg
    before = F.coalesce(F.try_divide(tp0, tp0 + fp0), here)
    sums = curve.groupBy("model").agg(
        F.sum(neg * (tp0 + pos / F.lit(2.0))).alias("roc"),
        F.sum(pos * (before + here) / F.lit(2.0)).alias("pr"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("q"),
    )
    return sums.select(
        "model",
        F.try_divide("roc", F.col("p") * F.col("q")).alias("roc_auc"),
        F.try_divide("pr", "p").alias("pr_auc"),
    )


def majority_baseline(rows: DataFrame, label: str = "compliant") -> DataFrame:
    """Accuracy of always predicting the commoner class (0.0 on no rows)."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.coalesce(F.try_divide(F.max("n"), F.sum("n")), F.lit(0.0)).alias("baseline_accuracy"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
    )


def threshold_sweep(predictions: DataFrame) -> DataFrame:
    """Precision, recall and F1 of the positive class at each threshold.

    Predictions are first counted by how many thresholds they reach (at most 18 groups per
    model and label); only those counts meet the thresholds.
    """
    listed = F.array(*map(F.lit, THRESHOLDS))
    reached = F.size(F.filter(listed, lambda t: t <= F.col("score")))
    counts = predictions.groupBy("model", reached.alias("reached")).agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") == 0).alias("neg"),
    )
    at = counts.select("*", F.posexplode(listed).alias("step", "threshold"))
    flagged = F.col("reached") > F.col("step")
    sums = at.groupBy("model", "threshold").agg(
        F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(flagged, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~flagged, F.col("pos")).otherwise(0)).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(
        "model",
        "threshold",
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Threshold with the highest F1 per model; ties go to the lowest threshold."""
    # rounding makes F1 values that differ only in the last bits true ties
    order = F.struct(F.round("f1", 12), -F.col("threshold"))
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"), order)
    return sweep.groupBy("model").agg(best.alias("best")).select("model", "best.*")


def calibration_curve(predictions: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score against observed frequency in equal right-closed bins of [0, 1]."""
    edges = [step / bins for step in range(bins + 1)]
    bucket = bucket_right_closed(F.col("score"), edges, range(1, bins + 1), include_lowest=True)
    return (
        predictions.groupBy("model", bucket.alias("bin"))
        .agg(
            F.avg("score").alias("predicted"),
            F.avg(F.col("label").cast("double")).alias("observed"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter(F.col("bin").isNotNull())
    )


def f1_per_second(metrics: DataFrame, seconds: DataFrame) -> DataFrame:
    """Metrics with training seconds and F1 per second; NULL when the time is unknown."""
    return metrics.join(seconds, "model", "left").withColumn(
        "f1_per_sec", F.round(F.try_divide("f1", "train_seconds"), 5)
    )


def model_comparison(predictions: DataFrame) -> DataFrame:
    """All metrics, one row per model that has predictions."""
    counts = confusion_counts(predictions)
    return (
        classification_metrics(counts)
        .join(areas_under_curves(predictions), "model")
        .join(confusion_metrics(counts), "model")
    )
