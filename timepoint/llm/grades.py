"""Quality grades by ordinal cumulative-link regression on hashed text.

A document's score is a weighted sum over its hashed words, their shapes and a few
measurements; ordered thresholds cut the score into grades: P(grade >= g) is the logistic
function of score minus threshold g. All grades share the weights, so a rating says more
than good or bad: it gives an expected grade, and tail probabilities to select by.

The model is fitted on a bounded sample of labelled rows (``SAMPLE``, by hash of the id, the
same on every run), by full-batch gradient steps in one task; its weights are 2^``BITS``
numbers. Scoring reads each document once and shuffles nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import WORD, arrow_map, durable

SAMPLE, BITS, STEPS, RATE, LEAST, PREFIX = 8000, 18, 200, 0.3, 8, 4
#: Penalty with which buckets are chosen, and with which the chosen ones are fitted again.
LASSO = (1.5e-3, 3e-4)
GRADES = 3
SELECT = 0.45
_SIZE = 1 << BITS
_WORDS = re.compile(WORD)
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CACHED = 300_000


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Rating from labels: 0 junk, 1 readable but toxic, 2 readable and clean; else NULL."""
    return (
        F.when(F.col(quality) == 0, 0)
        .when((F.col(quality) == 1) & (F.col(toxic) == 1), 1)
        .when((F.col(quality) == 1) & F.coalesce(F.col(toxic) == 0, F.lit(True)), 2)
    )


class _Buckets(dict):
    """Word -> buckets of the word, of its first letters and of its shape, in one number."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED:
            self.clear()
        core = word.strip(_EDGES)
        shape = ("A" if core.isupper() and len(core) > 1 else "a" if core else "") + word[
            len(word.rstrip(_EDGES)) :
        ]
        low = core.lower()
        value = 0
        for name in ("w" + low, "p" + low[:PREFIX], "s" + shape):
            value = (value << BITS) | (xxhash.xxh32_intdigest(name) % _SIZE)
        self[word] = value
        return value


def features(text: str | None, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: saturating for words, by share for shapes and measures."""
    words = _WORDS.findall(text or "")
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    both = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
    word, times = np.unique(both >> 2 * BITS, return_counts=True)
    prefix, began = np.unique((both >> BITS) & (_SIZE - 1), return_counts=True)
    shape, shaped = np.unique(both & (_SIZE - 1), return_counts=True)
    n = len(words)
    top = times.max() / n
    measures = [
        xxhash.xxh32_intdigest(f"{name}{min(9, int(10 * share))}") % _SIZE
        for name, share in (
            ("top", top if n >= 20 else 0.0),
            ("distinct", len(word) / n if n >= 20 else 0.9),
            ("length", sum(map(len, words)) / n / 20),
        )
    ]
    # a word's weight must not fade in a long text, nor many words drown a single one
    rates = [np.minimum(1.0, np.sqrt(x * 400.0 / max(n, 100))) for x in (times, began)]
    index = np.concatenate([word, prefix, shape, measures]).astype(np.int32)
    value = np.concatenate([*rates, 3 * np.sqrt(shaped / n), np.ones(len(measures))])
    return index, value.astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Weights by bucket and thresholds, in order, of grades 1 and up."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        """P(grade >= g) for g = 1, 2, ..."""
        score = float(self.weights[index] @ value)
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -50, 50)))


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int = GRADES) -> Model:
    """Penalised maximum likelihood, twice; rare grades count more.

    The penalty is on absolute weights, so words that say nothing get none. It also shrinks
    the others, hence the second fit of those alone with a small penalty. Buckets that fewer
    than ``LEAST`` documents fill are left out.
    """
    if not rows:
        return Model(np.zeros(_SIZE), np.arange(grades - 1, dtype=float))
    doc = np.repeat(np.arange(len(rows)), [len(i) for i, _, _ in rows])
    index = np.concatenate([i for i, _, _ in rows])
    value = np.concatenate([v for _, v, _ in rows]).astype(np.float64)
    y = np.array([g for _, _, g in rows])
    used = np.bincount(index, minlength=_SIZE) >= LEAST
    model = None
    for penalty in LASSO:
        keep = used[index]
        model = _fitted(doc[keep], index[keep], value[keep], y, grades, penalty)
        used = model.weights != 0
    return model


def _fitted(
    doc: np.ndarray, index: np.ndarray, value: np.ndarray, y: np.ndarray, grades: int, penalty: float
) -> Model:
    """Adaptive proximal gradient steps from zero weights."""
    n = len(y)
    weights, gaps = np.zeros(_SIZE), np.zeros(grades - 1)
    gaps[0] = -1.0  # thresholds: the first, then logarithms of the steps to the next
    seen_w, seen_t = np.full(_SIZE, 1e-8), np.full(grades - 1, 1e-8)
    per_grade = np.bincount(y, minlength=grades)
    importance = np.sqrt(n / np.maximum(per_grade, 1))
    share = importance[y] / importance[y].sum()

    def thresholds() -> np.ndarray:
        return np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))

    def logistic(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(-x, -50, 50)))

    for _ in range(STEPS):
        score = np.bincount(doc, value * weights[index], minlength=n)
        theta = np.concatenate([[-np.inf], thresholds(), [np.inf]])
        below, upto = logistic(theta[y] - score), logistic(theta[y + 1] - score)
        mass = np.maximum(upto - below, 1e-12)  # P(grade = y)
        low, high = share * below * (1 - below) / mass, share * upto * (1 - upto) / mass
        grad_w = np.bincount(index, value * (high - low)[doc], minlength=_SIZE)
        by_theta = (
            np.bincount(y, low, minlength=grades)[1:] - np.bincount(y, high, minlength=grades)[:-1]
        )
        tail = np.cumsum(by_theta[::-1])[::-1]
        grad_t = np.concatenate([tail[:1], tail[1:] * np.exp(gaps[1:])])
        seen_w += grad_w**2
        seen_t += grad_t**2
        step = RATE / np.sqrt(seen_w)
        weights = weights - step * grad_w
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * penalty, 0)
        gaps = gaps - RATE * grad_t / np.sqrt(seen_t)
    return Model(weights, thresholds())


def labelled(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, grade, text) of at most ``sample`` rated documents, chosen by hash of the id."""
    rated = (
        ratings.filter("doc_id IS NOT NULL AND grade IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # the sample is bounded by its parameter
    return texts.join(F.broadcast(durable(rated)), "doc_id")


def fit(rows: DataFrame, grades: int = GRADES) -> Model:
    """The model of rated texts (doc_id, grade, text): a bounded sample, as ``labelled`` gives."""

    def prepared(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        buckets = _Buckets()
        for batch in batches:
            found = [features(text, buckets) for text in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "grade": batch["grade"],
                "index": [i.tobytes() for i, _ in found],
                "value": [v.tobytes() for _, v in found],
            }

    def fitted(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        rows = [
            (doc, np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), g)
            for batch in batches
            for doc, i, v, g in zip(*(batch[c] for c in ("doc_id", "index", "value", "grade")), strict=True)
        ]
        # one order whatever the tasks were, so that sums agree to the last bit
        rows.sort(key=lambda r: (r[0], r[1].tobytes()))
        model = fit_rows([r[1:] for r in rows], grades)
        yield {
            "weights": [model.weights.astype(np.float64).tobytes()],
            "thresholds": [model.thresholds.tobytes()],
        }

    kind = rows.schema["doc_id"].dataType.simpleString()
    ready = arrow_map(
        rows.select("doc_id", F.col("grade").cast("int").alias("grade"), "text"),
        f"doc_id {kind}, grade int, index binary, value binary",
        prepared,
    )
    row = arrow_map(ready.repartition(1), "weights binary, thresholds binary", fitted).first()
    return Model(np.frombuffer(row.weights), np.frombuffer(row.thresholds))


def graded(docs: DataFrame, model: Model, select: float = SELECT) -> DataFrame:
    """Per row of ``docs``: doc_id, expected_grade, p_top (tail probability of the highest
    grade) and kept (p_top reaches ``select``).

    NULL, empty and blank texts have no features: their expected grade and tail are 0 and
    they are not kept. Rows are independent: repeated rows and other columns do not matter.
    """
    schema = "expected_grade double, p_top double"

    @F.pandas_udf(schema)
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        buckets = _Buckets()
        for batch in texts:
            found = []
            for text in batch:
                index, value = features(text, buckets)
                tails = model.tails(index, value) if len(index) else np.zeros(1)
                found.append((float(tails.sum()), float(tails[-1])))
            yield pd.DataFrame(found, columns=["expected_grade", "p_top"], dtype="float64")

    scored = docs.select("doc_id", score(F.col("text").cast("string")).alias("s"))
    return scored.select("doc_id", "s.*").withColumn("kept", F.col("p_top") >= select)


def quality_grades(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Fit on the labels and grade every document."""
    ratings = labels.select("doc_id", grade().alias("grade"))
    return graded(docs, fit(labelled(docs, ratings, sample)))
