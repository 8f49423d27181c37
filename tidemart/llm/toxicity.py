"""Severity of toxic text by cumulative-link ordinal regression on sparse word features.

P(grade <= j | x) = sigmoid(threshold_j - w x): one weight per feature serves all
ordered thresholds. The result is the expected grade.

The labels know toxic and not toxic only. Grade 0 is not toxic; a toxic
document gets grade 1, 2 or 3 by thirds of the number of telling words that it
holds, in proportion to its length. The model is fitted on a bounded sample of
labelled rows (``sample_rows``) and scores every document. The chance from which
a document counts as toxic is the one with the best F1 on a quarter of the
sample that was held out.

Handling: a null or empty text has score 0 and the grade that the thresholds give it. Texts
are read whole, however long. Rows that repeat are scored alike, each for itself, and are one row of the
sample. Labels with a null id or grade, or of documents that are not there, take no part; of two
labels of an id the worse counts. Words as telling as each other are ranked by their bytes. Only the named columns
are read and made columns begin with ``#``, so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemart.llm.common import SparseRows, binary, minimize, sigmoid, stage, table
from tidemart.llm.samples import SAMPLE_ROWS, bare_words, labelled, present, telling_words, words_and_stems

GRADES = 4
FEATURES = 384
RIDGE = 0.3
HELD_OUT = 4
CUES = 64


@dataclass(frozen=True)
class OrdinalModel:
    vocabulary: dict[bytes, int]
    weights: np.ndarray
    thresholds: np.ndarray
    toxic_from: float = 0.5

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """P(grade = j) for every row."""
        up_to = np.column_stack([sigmoid(t - scores) for t in self.thresholds])
        return np.diff(up_to, axis=1, prepend=0.0, append=1.0)

    def score(self, value: bytes | None) -> float:
        found = [self.vocabulary[w] for w in self.vocabulary.keys() & words_and_stems(value)]
        return float(self.weights[sorted(found)].sum())


def fit_ordinal(rows: SparseRows, grades: np.ndarray, levels: int = GRADES, ridge: float = RIDGE):
    """Weights and ordered thresholds of greatest penalized likelihood."""
    k = levels - 1
    n = len(grades)
    shares = np.array([(np.sum(grades <= j) + 0.5) / (n + 1) for j in range(k)])
    start = np.log(shares / (1 - shares))
    steps = np.log(np.maximum(np.diff(start), 1e-2))
    beginning = np.r_[start[0], steps, np.zeros(rows.width)]

    def thresholds(p: np.ndarray) -> np.ndarray:
        return p[0] + np.r_[0.0, np.cumsum(np.exp(np.clip(p[1:k], -20, 20)))]

    def value_and_slope(p: np.ndarray):
        t, w = thresholds(p), p[k:]
        scores = rows.times(w)
        upper = np.where(grades < k, t[np.minimum(grades, k - 1)] - scores, np.inf)
        lower = np.where(grades > 0, t[np.maximum(grades - 1, 0)] - scores, -np.inf)
        high, low = np.where(np.isinf(upper), 1.0, sigmoid(upper)), np.where(np.isinf(lower), 0.0, sigmoid(lower))
        chance = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / chance, low * (1 - low) / chance
        by_threshold = -(np.bincount(np.minimum(grades, k - 1), d_high * (grades < k), k)
                         - np.bincount(np.maximum(grades - 1, 0), d_low * (grades > 0), k))
        slope = np.empty_like(p)
        slope[0] = by_threshold.sum()
        slope[1:k] = np.cumsum(by_threshold[::-1])[::-1][1:] * np.exp(np.clip(p[1:k], -20, 20))
        slope[k:] = rows.back(d_high - d_low) + ridge * w
        return -np.log(chance).sum() + ridge / 2 * (w @ w), slope

    p = minimize(value_and_slope, beginning)
    return p[k:], thresholds(p)


def best_cut(chance: np.ndarray, toxic: np.ndarray) -> float:
    """The chance from which on a row counts as toxic, with the best F1 on rows held out.

    The middle, in log odds, of all cuts that are as good as the best one.
    """
    if not toxic.any() or toxic.all():
        return 0.5
    order = np.argsort(-chance, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + toxic.sum())
    ends = np.append(np.diff(chance[order]) < 0, True)
    best = np.flatnonzero(ends & (f1 >= f1[ends].max() - 1e-12))
    odds = np.log(chance[order] / (1 - chance[order]))
    upper, lower = odds[best[0]], odds[best[-1] + 1] if best[-1] + 1 < len(order) else odds[best[-1]] - 2
    return float(sigmoid((upper + lower) / 2))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> OrdinalModel:
    """Without labelled rows of both classes the model holds nothing for toxic."""
    rows = stage(labelled(docs.select("doc_id", "text"), labels, "toxic", sample_rows).select("text", "#label", "#order"), "toxic")
    vocabulary = telling_words(rows, features, tokens=words_and_stems)
    if not vocabulary:
        return OrdinalModel({}, np.zeros(1), np.array([30.0, 31.0, 32.0]))

    def features_of(batches):
        for batch in batches:
            found, sizes = [], []
            for value in binary(batch.column(0)):
                found.append(present(words_and_stems(value), vocabulary))
                sizes.append(len(bare_words(value)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), pa.array(sizes, pa.int64()), *batch.columns[1:]],
                ["found", "words", "label", "order"])

    sample = rows.mapInArrow(features_of, "found array<int>, words long, label int, order long").toArrow().sort_by("order")
    toxic = sample.column("label").to_numpy() > 0
    matrix = SparseRows.of(sample.column("found"), len(vocabulary))
    # Words that stand in toxic documents rather than in others.
    in_toxic = np.bincount(matrix.column, toxic[matrix.row].astype(float), len(vocabulary))
    in_other = np.bincount(matrix.column, (~toxic[matrix.row]).astype(float), len(vocabulary))
    odds = np.log((in_toxic + 0.5) / (toxic.sum() + 1)) - np.log((in_other + 0.5) / ((~toxic).sum() + 1))
    cue = np.zeros(len(vocabulary))
    cue[[k for k in range(min(CUES, len(cue))) if odds[k] > 1]] = 1.0
    density = matrix.times(cue) / np.maximum(1, sample.column("words").to_numpy())
    cuts = np.quantile(density[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + (density > cuts[0]) + (density > cuts[1]), 0)
    held = np.arange(len(grades)) % HELD_OUT == 0
    weights, thresholds = fit_ordinal(matrix.take(np.flatnonzero(~held)), grades[~held])
    scores = matrix.take(np.flatnonzero(held)).times(weights)
    cut = best_cut(np.clip(1 - sigmoid(thresholds[0] - scores), 1e-9, 1 - 1e-9), toxic[held])
    return OrdinalModel(vocabulary, *fit_ordinal(matrix, grades), cut)


def grade_chances(docs: DataFrame, model: OrdinalModel, text_column: str = "text", out: str = "#chances") -> DataFrame:
    """``docs`` with an array of the chances of each grade. A null or empty text has score 0."""

    @F.arrow_udf(ArrayType(DoubleType()))
    def chances(texts: pa.Array) -> pa.Array:
        scores = np.array([model.score(value) for value in binary(texts)])
        return pa.array(list(model.chances(scores)) if len(scores) else [], pa.list_(pa.float64()))

    return docs.withColumn(out, chances(F.col(text_column)))


def severity(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id, expected ``severity``, most likely ``grade``, ``p_toxic`` and ``toxic``, a row for each row."""
    chances = F.col("#chances")
    return grade_chances(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.aggregate(F.sequence(F.lit(1), F.lit(GRADES - 1)), F.lit(0.0), lambda s, j: s + j * chances[j]).alias("severity"),
        (F.array_position(chances, F.array_max(chances)) - 1).cast("int").alias("grade"),
        (1 - chances[0]).alias("p_toxic"), (1 - chances[0] >= model.toxic_from).alias("toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns kept."""
    model = train(docs, labels)
    return grade_chances(docs, model).filter(1 - F.col("#chances")[0] < model.toxic_from).drop("#chances")


def op2_toxicity_severity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return severity(docs, train(docs, table(spark, folder, "labels")))
