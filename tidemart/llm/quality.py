"""Quality of documents by co-training of a text view and a metadata view.

The text view has words and how they repeat; the metadata view has the source,
the language, the declared length and the layout (lines, signs, capitals). Each
view has a logistic classifier. Over some rounds each gives the labels that it
is sure of, on unlabelled documents, to the other. Then both are calibrated on
labelled documents that were held out, and their log odds are combined.

The classifiers are fitted on bounded samples (``sample_rows`` labelled and as
many unlabelled documents); every document is scored.

Handling: a null text is measured as empty; null source, language and length are values of
their own. Texts are read whole, however long. Rows that repeat are scored alike, each for itself, and are
one row of the sample. Labels with a null id or grade, or of documents that are not there, take no
part; of two labels of an id the better counts. Equally sure documents of the pool are taken in
the order of their hash. Only the named columns are read and made columns begin with ``#``, so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemart.llm.common import SparseRows, binary, minimize, sigmoid, stage, table
from tidemart.llm.samples import (
    BARE, SAMPLE_ROWS, by_hash, labelled, once_each, present, telling_words, with_order,
)

FEATURES = 2048
RIDGE = 1.0
ROUNDS = 3
SURE = 0.98
TAKEN_PER_ROUND = 0.1
HELD_OUT = 5
GOOD_FROM = 0.5
BINS = 16
SOURCE_SLOTS, LANG_SLOTS = 256, 64
TEXT_NUMBERS, META_NUMBERS = 4, 6

_CAPITALS = bytes(range(65, 91))
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_DIGITS = b"0123456789"


def measures(value: bytes | None, declared: int | None) -> tuple[set[bytes], list[float], list[float]]:
    """Distinct words; numbers of the text view; numbers of the metadata view."""
    value = value or b""
    size = max(1, len(value))
    words = value.translate(BARE).split()
    n = max(1, len(words))
    distinct = set(words)
    lines = value.count(b"\n") + 1
    repeated = sum(map(eq, words, words[1:]))
    part = lambda drop: (len(value) - len(value.translate(None, drop))) / size
    text = [len(distinct) / n, repeated / n, sum(map(len, words)) / n, np.log1p(n)]
    meta = [np.log1p(declared if declared is not None and declared >= 0 else 0), np.log1p(lines), np.log1p(size / lines),
            part(_SIGNS), part(_CAPITALS), part(_DIGITS)]
    return distinct, text, meta


def slot(value: str | None, slots: int) -> int:
    return crc32(value.encode()) % slots if value is not None else slots


@dataclass(frozen=True)
class Encoder:
    vocabulary: dict[bytes, int]
    text_cuts: np.ndarray
    meta_cuts: np.ndarray

    @property
    def text_width(self) -> int:
        return 1 + len(self.vocabulary) + TEXT_NUMBERS * BINS

    @property
    def meta_width(self) -> int:
        return 1 + META_NUMBERS * BINS + SOURCE_SLOTS + LANG_SLOTS + 2

    def text_rows(self, words: SparseRows, numbers: np.ndarray) -> SparseRows:
        """A constant, the words and the bins of the numbers of each document."""
        n, more = words.n, 1 + TEXT_NUMBERS
        ends = words.ends + more * np.arange(n + 1)
        column = np.zeros(ends[-1], np.int32)
        column[np.arange(len(words.column)) + more * words.row.astype(np.int64) + 1] = 1 + words.column
        bins = (numbers[:, :, None] > self.text_cuts).sum(axis=2)
        at = np.arange(TEXT_NUMBERS)
        column[ends[1:, None] - TEXT_NUMBERS + at] = 1 + len(self.vocabulary) + at * BINS + bins
        return SparseRows(column, ends, self.text_width)

    def meta_rows(self, numbers: np.ndarray, sources: list[str | None], langs: list[str | None]) -> SparseRows:
        bins = (numbers[:, :, None] > self.meta_cuts).sum(axis=2)
        base = 1 + META_NUMBERS * BINS
        column = np.zeros((len(sources), META_NUMBERS + 3), np.int32)
        column[:, 1:-2] = 1 + np.arange(META_NUMBERS) * BINS + bins
        column[:, -2] = [base + slot(x, SOURCE_SLOTS) for x in sources]
        column[:, -1] = [base + SOURCE_SLOTS + 1 + slot(x, LANG_SLOTS) for x in langs]
        return SparseRows(column.reshape(-1), column.shape[1] * np.arange(len(column) + 1), self.meta_width)


@dataclass(frozen=True)
class Views:
    encoder: Encoder
    text_weights: np.ndarray
    meta_weights: np.ndarray
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    joint_scale: tuple[float, float]
    prior: float

    def combine(self, text_scores: np.ndarray, meta_scores: np.ndarray) -> np.ndarray:
        """Calibrated log odds of both views, the prior counted once, calibrated again."""
        a, b = self.text_scale
        c, d = self.meta_scale
        both = (a * text_scores + b) + (c * meta_scores + d) - self.prior
        e, f = self.joint_scale
        return sigmoid(e * both + f)


def fit_logistic(rows: SparseRows, labels: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    def value_and_slope(w: np.ndarray):
        scores = rows.times(w)
        slope = rows.back(sigmoid(scores) - labels) + ridge * w
        slope[0] -= ridge * w[0]
        return np.logaddexp(0, scores).sum() - labels @ scores + ridge / 2 * (w[1:] @ w[1:]), slope

    return minimize(value_and_slope, np.zeros(rows.width))


def calibration(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn scores into log odds, on rows held out."""

    def value_and_slope(p: np.ndarray):
        odds = p[0] * scores + p[1]
        off = sigmoid(odds) - labels
        return np.logaddexp(0, odds).sum() - labels @ odds + 0.5 * (p[0] - 1) ** 2 + 0.05 * p[1] ** 2, np.array(
            [off @ scores + p[0] - 1, off.sum() + 0.1 * p[1]])

    a, b = minimize(value_and_slope, np.array([1.0, 0.0]))
    return float(max(a, 0.0)), float(b)


def co_train(text: SparseRows, meta: SparseRows, labels: np.ndarray, text_pool: SparseRows, meta_pool: SparseRows,
             encoder: Encoder, rounds: int = ROUNDS) -> Views:
    """Fits both views; ``labels`` belong to the rows, the pool has none."""
    held = np.arange(len(labels)) % HELD_OUT == 0
    learned, kept_out = np.flatnonzero(~held), np.flatnonzero(held)
    views = [(text, text_pool), (meta, meta_pool)]
    given: list[dict[int, int]] = [{}, {}]  # pseudo-labels that a view received, by row of the pool
    for number in range(rounds + 1):
        weights = []
        for (rows, pool), received in zip(views, given):
            own = rows.take(learned) + pool.take(np.array(list(received), np.int64))
            weights.append(fit_logistic(own, np.r_[labels[learned], list(received.values())]))
        if number == rounds or not text_pool.n:
            break
        most = max(1, int(TAKEN_PER_ROUND * text_pool.n))
        for k, (rows, pool) in enumerate(views):
            chance = sigmoid(pool.times(weights[k]))
            for label, sure in ((1, chance), (0, 1 - chance)):
                order = np.argsort(-sure, kind="stable")[:most]
                given[1 - k].update({int(i): label for i in order if sure[i] >= SURE and int(i) not in given[1 - k]})
    scores = [rows.take(kept_out).times(w) for (rows, _), w in zip(views, weights)]
    truth = labels[held].astype(float)
    prior = float(np.log((truth.sum() + 0.5) / (len(truth) - truth.sum() + 0.5)))
    scales = [calibration(s, truth) for s in scores]
    both = sum(a * s + b for s, (a, b) in zip(scores, scales)) - prior
    return Views(encoder, *weights, *scales, calibration(both, truth), prior)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Views | None:
    """None without labelled rows of both classes."""
    few = docs.select("doc_id", "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"))
    marked = labelled(few, labels, "quality", sample_rows)
    # As many other documents, labels unseen, each of those that repeat id and text once.
    seen = marked.select(F.col("doc_id").alias("#seen")).distinct()
    pool = once_each(with_order(few).filter(by_hash(sample_rows / max(1, docs.count()))))
    pool = pool.join(seen, F.col("doc_id") == F.col("#seen"), "left_anti").withColumn("#label", F.lit(None).cast("int"))
    rows = stage(marked.unionByName(pool), "quality")
    vocabulary = telling_words(rows.filter(F.col("#label").isNotNull()), FEATURES)
    if not vocabulary:
        return None

    def measured(batches):
        for batch in batches:
            found, text, meta = [], [], []
            for value, declared in zip(binary(batch.column(0)), batch.column(1).to_pylist()):
                words, a, b = measures(value, declared)
                found.append(present(words, vocabulary))
                text.append(a)
                meta.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), pa.array(text, pa.list_(pa.float64())),
                 pa.array(meta, pa.list_(pa.float64())), *batch.columns[2:]],
                ["found", "text", "meta", "source", "lang", "label", "order"])

    sample = rows.select("text", "n_chars", "source", "lang", "#label", "#order").mapInArrow(
        measured, "found array<int>, text array<double>, meta array<double>, source string, lang string, "
                  "label int, order long").toArrow().sort_by("order")
    square = lambda name, n: sample.column(name).combine_chunks().flatten().to_numpy().reshape(-1, n)
    text, meta = square("text", TEXT_NUMBERS), square("meta", META_NUMBERS)
    cuts = lambda x: np.quantile(x, np.arange(1, BINS) / BINS, axis=0).T
    encoder = Encoder(vocabulary, cuts(text), cuts(meta))
    text_rows = encoder.text_rows(SparseRows.of(sample.column("found"), len(vocabulary)), text)
    meta_rows = encoder.meta_rows(meta, sample.column("source").to_pylist(), sample.column("lang").to_pylist())
    marks = sample.column("label").to_numpy().astype(float)
    own, rest = np.flatnonzero(~np.isnan(marks)), np.flatnonzero(np.isnan(marks))
    return co_train(text_rows.take(own), meta_rows.take(own), marks[own], text_rows.take(rest), meta_rows.take(rest), encoder)


def with_quality(docs: DataFrame, model: Views | None, out: str = "#quality") -> DataFrame:
    """``docs`` with the chance of good quality; 1 for every row if there is no model.

    Null text: measured as empty. Null source, language or length: values of their own.
    """
    if model is None:
        return docs.withColumn(out, F.lit(1.0))

    @F.arrow_udf(DoubleType())
    def chance(texts: pa.Array, declared: pa.Array, sources: pa.Array, langs: pa.Array) -> pa.Array:
        one = model.encoder
        found, text, meta = [], [], []
        for value, n in zip(binary(texts), declared.to_pylist()):
            words, a, b = measures(value, n)
            found.append(present(words, one.vocabulary))
            text.append(a)
            meta.append(b)
        ends = np.cumsum([0, *map(len, found)])
        words = SparseRows(np.concatenate([np.zeros(0, np.int32), *found]), ends, len(one.vocabulary))
        text_scores = one.text_rows(words, np.array(text).reshape(-1, TEXT_NUMBERS)).times(model.text_weights)
        meta_scores = one.meta_rows(np.array(meta).reshape(-1, META_NUMBERS), sources.to_pylist(), langs.to_pylist()).times(
            model.meta_weights)
        return pa.array(model.combine(text_scores, meta_scores))

    return docs.withColumn(out, chance("text", F.col("n_chars").cast("long"), "source", "lang"))


def quality(docs: DataFrame, model: Views | None, good_from: float = GOOD_FROM) -> DataFrame:
    """doc_id, ``score`` and ``good``, a row for each row."""
    columns = ("doc_id", "text", "n_chars", "source", "lang")
    return with_quality(docs.select(*columns), model).select(
        "doc_id", F.col("#quality").alias("score"), (F.col("#quality") >= good_from).alias("good"))


def keep_good(docs: DataFrame, labels: DataFrame, good_from: float = GOOD_FROM) -> DataFrame:
    """The rows of ``docs`` of good quality, all columns kept."""
    return with_quality(docs, train(docs, labels)).filter(F.col("#quality") >= good_from).drop("#quality")


def op4_quality_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality(docs, train(docs, table(spark, folder, "labels")))
