"""Quality classifier: naive Bayes features under a linear support vector machine.

A text is the set of its byte n-grams and word pairs, hashed into a fixed number
of buckets, and of its runs of one repeated word by length. Each bucket's indicator is scaled by its log-count ratio between the
two classes, and a hinge-loss linear model is fitted to the scaled indicators by
dual coordinate descent. Margins become scores through a sigmoid fitted on
training rows that the descent did not see.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import WordHasher, grouped, logistic, mixed, sliced, training_sample

NGRAMS = (3, 4)
BUCKET_BITS = 16
#: Runs of one word: an indicator for each length from 2 on, whatever the word.
RUNS = 16
#: Bound of the labelled rows which the model is fitted on.
TRAINING_ROWS = 6000
FEATURES = (1 << BUCKET_BITS) + RUNS
_SCHEMA = "doc_id LONG, label INT, features ARRAY<INT>"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class QualityModel:
    """One weight per bucket, and the sigmoid's slope and intercept.

    ``default`` is the score of a text without features: the share of label 1
    among the training rows (0.5 where there are none).
    """

    weights: np.ndarray
    bias: float
    slope: float
    intercept: float
    default: float

    def score(self, features: np.ndarray) -> float:
        if not len(features):
            return self.default
        margin = float(self.weights[features].sum()) / math.sqrt(len(features)) + self.bias
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.slope * margin + self.intercept))))


def text_features(texts: Iterator[bytes]) -> Iterator[np.ndarray]:
    """The distinct buckets of each text, in order."""
    hasher = WordHasher()
    shift = np.uint64(64 - BUCKET_BITS)
    seen = np.zeros(FEATURES, bool)
    for group in grouped(texts):
        data = b" ".join(group)
        codes = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        grams = []
        for n in NGRAMS:
            value = np.full(max(0, len(codes) - n + 1), n, np.uint64)
            for i in range(n):
                value = value * np.uint64(257) + codes[i : len(codes) - n + 1 + i]
            grams.append(((value * _MULTIPLIER) >> shift).astype(np.int32))
        at = 0
        for text, words in zip(group, hasher.each(group)):
            parts = [g[at : at + max(0, len(text) - n + 1)] for n, g in zip(NGRAMS, grams)]
            if len(words) > 1:
                pairs = mixed(words[:-1] * _MULTIPLIER + words[1:])
                parts.append((pairs >> shift).astype(np.int32))
                breaks = np.flatnonzero(np.concatenate([[True], words[:-1] != words[1:], [True]]))
                longest = int(np.diff(breaks).max())
                seen[FEATURES - RUNS : FEATURES - RUNS + min(longest - 1, RUNS)] = True
            at += len(text) + 1
            for part in parts:
                seen[part] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            yield found.astype(np.int32)


def fit(labels: np.ndarray, rows: list[np.ndarray], epochs: int = 40, cost: float = 10.0) -> QualityModel:
    """The model of labelled feature sets; every fifth row only sets the sigmoid."""
    size = FEATURES
    share = float(labels.mean()) if len(labels) else 0.5
    if not 0 < share < 1:
        return QualityModel(np.zeros(size, np.float32), 0.0, 0.0, _logit(share), _clipped(share))
    held = np.arange(len(rows)) % 5 == 4
    if len(set(labels[~held])) < 2 or len(set(labels[held])) < 2:
        held[:] = False
    learn = np.flatnonzero(~held)

    counts = np.ones((2, size))
    for i in learn:
        counts[labels[i], rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())

    # Scaled indicators over the root of their number: no text weighs by its length.
    scaled = [
        (ratio[row] / math.sqrt(max(1, len(row)))).astype(np.float32) for row in rows
    ]
    weights, bias = np.zeros(size), 0.0
    signs = np.where(labels == 1, 1.0, -1.0)
    # Both classes count alike, however rare one is.
    upper = np.where(labels == 1, cost / (2 * share), cost / (2 * (1 - share)))
    norms = np.array([float(x @ x) + 1.0 for x in scaled])
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        largest = 0.0
        for i in order.permutation(learn):
            gradient = signs[i] * (weights[rows[i]] @ scaled[i] + bias) - 1.0
            step = min(max(alpha[i] - gradient / norms[i], 0.0), upper[i]) - alpha[i]
            if step:
                alpha[i] += step
                weights[rows[i]] += (step * signs[i]) * scaled[i]
                bias += step * signs[i]
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    margins = np.array([weights[row] @ x + bias for row, x in zip(rows, scaled)])
    check = np.flatnonzero(held) if held.any() else learn
    slope, intercept = _sigmoid(margins[check], labels[check])
    return QualityModel((weights * ratio).astype(np.float32), bias, slope, intercept, _clipped(share))


def _sigmoid(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of Platt's sigmoid."""
    ones = float(labels.sum())
    zeros = len(labels) - ones
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    slope, intercept = logistic(margins[:, None], target)
    return max(float(slope), 1e-3), float(intercept)


def _clipped(share: float) -> float:
    return min(max(share, 0.01), 0.99)


def _logit(share: float) -> float:
    p = _clipped(share)
    return math.log(p / (1 - p))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS) -> QualityModel:
    """Fit on at most ``max_rows`` labelled documents (see ``training_sample``).

    Features are worked out in the tasks that hold the texts; one task then fits
    the model on at most ``max_rows`` feature sets of bounded size.
    """
    sample = training_sample(docs, labels, "quality", max_rows)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = (t.encode() for t in batch.column("text").to_pylist())
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "label": batch.column("label"),
                    "features": pa.array(list(text_features(texts)), pa.list_(pa.int32())),
                }
            )

    def fit_all(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table.column("doc_id")), kind="stable")
        found = [np.asarray(r.values) for r in table.column("features")]
        model = fit(np.asarray(table.column("label"))[order], [found[i] for i in order])
        return pa.table(
            {
                "weights": pa.array([model.weights.tobytes()], pa.binary()),
                "numbers": pa.array(
                    [[model.bias, model.slope, model.intercept, model.default]],
                    pa.list_(pa.float64()),
                ),
            }
        )

    fitted = (
        sample.select("doc_id", "label", "text")
        .mapInArrow(featurise, _SCHEMA)
        .groupBy(F.lit(1).alias("all"))
        .applyInArrow(fit_all, "weights BINARY, numbers ARRAY<DOUBLE>")
        .first()
    )
    if fitted is None:
        return QualityModel(np.zeros(FEATURES, np.float32), 0.0, 0.0, 0.0, 0.5)
    return QualityModel(np.frombuffer(fitted["weights"], np.float32), *fitted["numbers"])


def scores(texts: list[str | None], model: QualityModel) -> list[float]:
    return [model.score(f) for f in text_features((t or "").encode() for t in texts)]


def score_documents(docs: DataFrame, model: QualityModel, threshold: float = 0.5) -> DataFrame:
    """``(doc_id, score, predicted)``, one row per document.

    A null text counts as empty; a text without features scores the share of
    label 1. Repeated rows are each scored; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = scores(batch.column("text").to_pylist(), model)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": pa.array(found, pa.float64()),
                    "predicted": pa.array([int(s >= threshold) for s in found], pa.int32()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id LONG, score DOUBLE, predicted INT")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that score at least ``threshold``.

    Null and empty texts have the model's ``default`` score; repeated rows are
    judged alike, row by row, and null ids are no matter. An empty table stays so.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = scores(batch.column(at).to_pylist(), model)
            yield batch.filter(pa.array([s >= threshold for s in found]))

    return docs.mapInArrow(run, docs.schema)
