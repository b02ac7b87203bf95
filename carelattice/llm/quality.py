"""Text quality by learning from trusted positives and unlabelled text.

Labels enter only as trusted positives (label 1 in training rows). A bounded sample of them and a bounded sample of
all documents, taken as unlabelled, are described by `text_stats`; each number is cut into bins, so the model is additive
and free in shape. First a plain classifier tells positives from unlabelled; on halves it was not fitted on, the
smallest ratio between the shares of unlabelled and of positive texts above a threshold estimates the class
prior. Then the non-negative unbiased risk  pi R+(P) + max(0, R-(U) - pi R-(P))  is minimised with the logistic loss, so
that the output is a probability. Every whole text of the table is then scored.

Null and empty texts have all-zero numbers and get a score like any other. Without positives, or without documents to
learn from, every score is the prior 0.5. Repeated rows are scored each; null doc_ids are never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, prepare, remainder, tidy_batches
from .features import STATS, adam, hash_sample, logistic, text_stats


#: Quantiles near the ends of a number's distribution that get bins of their own.
TAILS = np.array([0.002, 0.005, 0.01, 0.02, 0.04, 0.07])


@dataclass
class Model:
    """An additive model: bin edges of each number, and a weight for each bin."""

    edges: np.ndarray  # numbers x (bins - 1)
    weights: np.ndarray  # numbers x bins
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for j, (edges, weights) in enumerate(zip(self.edges, self.weights, strict=True)):
            total += weights[np.searchsorted(edges, x[:, j], side="right")]
        return logistic(total)


def _binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One-hot bins, and a constant."""
    bins = edges.shape[1] + 1
    out = np.zeros((len(x), len(edges) * bins + 1))
    out[:, -1] = 1
    for j, e in enumerate(edges):
        out[np.arange(len(x)), j * bins + np.searchsorted(e, x[:, j], side="right")] = 1
    return out


def estimate_prior(p: np.ndarray, u: np.ndarray, steps: int, ridge: float) -> float:
    """Share of positives among the unlabelled rows `u`, given positives `p` (binned)."""

    def fitted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        def gradient(w: np.ndarray) -> np.ndarray:
            return a.T @ (logistic(a @ w) - 1) / len(a) + b.T @ logistic(b @ w) / len(b) + ridge * w

        return adam(gradient, a.shape[1], steps)

    estimates = []
    for own in (0, 1):
        a, b = p[own::2], u[own::2]
        w = fitted(p[1 - own :: 2], u[1 - own :: 2])
        sp, su = np.sort(a @ w), np.sort(b @ w)
        cuts = sp[: int(0.8 * len(sp)) + 1]  # at least a fifth of the positives stays above
        above_p = 1 - np.searchsorted(sp, cuts) / len(sp)
        above_u = 1 - np.searchsorted(su, cuts) / len(su)
        slack = np.sqrt(np.log(4 * max(2, len(cuts))) / 2) * (len(sp) ** -0.5 + len(su) ** -0.5)
        best = np.argmin((above_u + slack) / above_p)
        estimates.append(above_u[best] / above_p[best])
    return float(np.clip(np.mean(estimates), 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, bins: int = 8, steps: int = 600, ridge: float = 3e-4) -> Model:
    """The model from the numbers of positive and unlabelled texts."""
    k = len(STATS)
    if len(positive) < 4 or len(unlabelled) < 4:
        return Model(np.zeros((k, 0)), np.zeros((k, 1)), 0.0, 0.5)
    # Edges where either sample varies, closer in the tails: poor texts are few and extreme.
    at = np.sort(np.concatenate([np.linspace(0, 1, bins + 1)[1:-1], TAILS, 1 - TAILS]))
    edges = np.concatenate([np.quantile(positive, at, axis=0), np.quantile(unlabelled, at, axis=0)])
    edges = np.sort(edges, axis=0).T
    p, u = _binned(positive, edges), _binned(unlabelled, edges)
    prior = estimate_prior(p, u, steps, ridge)

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        minus_p, minus_u = p.T @ logistic(zp) / len(p), u.T @ logistic(zu) / len(u)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if negative < 0:  # the estimate of a risk is below zero: step back from it
            return -(minus_u - prior * minus_p) + ridge * w
        return prior * p.T @ (logistic(zp) - 1) / len(p) + minus_u - prior * minus_p + ridge * w

    w = adam(gradient, p.shape[1], steps)
    return Model(edges, w[:-1].reshape(k, -1), float(w[-1]), prior)


def _numbers(docs: DataFrame) -> np.ndarray:
    """`text_stats` of a bounded sample."""

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_stats(t, t.split()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["x"])

    rows = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(tidy_batches(stats), "x array<double>").collect()
    return np.array(sorted(r[0] for r in rows)).reshape(len(rows), len(STATS))


def learn(docs: DataFrame, labels: DataFrame, positives: int = 8000, unlabelled: int = 16000) -> Model:
    """Fit on at most about so many trusted positives of `labels` (doc_id, quality) and documents."""
    prepare(docs.sparkSession)
    texts = documents(docs)
    trusted = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long")).distinct()
    trusted = F.broadcast(hash_sample(trusted, positives))  # bounded by the sample
    return fit(_numbers(texts.join(trusted, "doc_id", "left_semi")), _numbers(hash_sample(texts, unlabelled)))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (probability of good quality) of every row."""
    prepare(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([text_stats(t, t.split()) for t in batch.column("text").to_pylist()])
            scores = model.score(x.reshape(batch.num_rows, len(STATS)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    rows = documents(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(tidy_batches(score), "doc_id long, score double")


def training_labels(labels: DataFrame, column: str, folds: int = 5) -> DataFrame:
    """Rows of `labels` whose crc32(doc_id as text) is not divisible by `folds`."""
    return labels.where(remainder("doc_id", folds) != 0).select("doc_id", column)
