"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a Gaussian over thirteen smoothed log statistics of a text. The class covariances shrink towards the
pooled one and towards a sphere; their Cholesky factors are inverted once and kept, so a score is two matrix products:
the difference of the log densities, put on the probability scale by a logistic fit on the sample.
"""

from __future__ import annotations

import operator
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: At most so many labelled documents of each class are used to fit; the first by hash of their ids.
SAMPLE_PER_CLASS = 8000
FOLDS, HELD = 3, 1
TO_POOL, TO_SPHERE = 0.1, 0.02

STATISTICS = ("length", "words", "word length", "capitals", "marks", "stops", "digits", "beyond ASCII", "distinct words", "repeated neighbours", "single characters", "repeated lines", "packed size")


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, as logarithms of smoothed counts and shares."""
    data = text.encode("utf-8", "replace")
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    capitals, small, digits, beyond = (int(counts[a:b].sum()) for a, b in ((65, 91), (97, 123), (48, 58), (128, 256)))
    spaces = int(counts[32] + counts[9:14].sum())
    stops = int(counts[44] + counts[46])
    marks = n - capitals - small - digits - beyond - spaces - stops
    words = text.split()
    w = len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    same = sum(map(operator.eq, words, islice(words, 1, None)))
    shares = (
        ((n + 1) / (w + 1), 1),
        (capitals + 1, capitals + small + beyond / 2 + 10),
        (marks + 1, n + 40),
        (stops + 1, w + 10),
        (digits + 1, n + 40),
        (beyond + 1, n + 40),
        (len(set(words)) + 1, w + 1),
        (same + 0.5, w + 20),
        (sum(map(operator.eq, map(len, words), (1 for _ in words))) + 1, w + 20),
        (len(lines) - len(set(lines)) + 0.5, len(lines) + 5),
        (len(zlib.compress(data, 1)) + 1, n + 12),
    )
    return [float(np.log(n + 20)), float(np.log(w + 5)), *(float(np.log(a / b)) for a, b in shares)]


class Discriminant:
    """Fitted on X [n, d] and labels y; without rows of one class, the score is the other class's certainty, and
    without any rows it is one half."""

    def __init__(self, X: np.ndarray, y: np.ndarray, prior: float | None = None):
        self.constant = None if len(set(y.tolist())) == 2 else float(y.mean()) if len(y) else 0.5
        if self.constant is not None:
            return
        d = X.shape[1]
        self.centre, self.spread = X.mean(0), X.std(0) + 1e-6
        Z = (X - self.centre) / self.spread
        groups = [Z[y == c] for c in (0, 1)]
        within = [np.cov(g.T, bias=True) if len(g) > 1 else np.zeros((d, d)) for g in groups]
        pooled = sum(len(g) * s for g, s in zip(groups, within, strict=True)) / len(Z)
        self.means = [g.mean(0) for g in groups]
        self.whiten, self.logdet = [], []
        for g, s in zip(groups, within, strict=True):
            to_pool = max(TO_POOL, min(1.0, d / (len(g) + 1)))
            s = (1 - to_pool) * s + to_pool * pooled
            s = (1 - TO_SPHERE) * s + TO_SPHERE * np.eye(d) * max(np.trace(s) / d, 1e-3)
            factor = np.linalg.cholesky(s)
            self.whiten.append(np.linalg.inv(factor))
            self.logdet.append(2 * np.log(np.diag(factor)).sum())
        self.slope, self.offset = 1.0, 0.0
        raw = self.difference(X)
        prior = y.mean() if prior is None else prior
        weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
        self._calibrate(raw, y, weight)

    def difference(self, X: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0, held to a range in which a logistic curve can tell."""
        Z = (X - self.centre) / self.spread
        logs = [-0.5 * (((Z - m) @ w.T) ** 2).sum(1) - 0.5 * v for m, w, v in zip(self.means, self.whiten, self.logdet, strict=True)]
        return np.clip(logs[1] - logs[0], -60, 60)

    def _calibrate(self, raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Slope and offset by Newton steps on the weighted logistic loss with a small ridge."""
        A, t = np.stack([raw / 10, np.ones(len(raw))], 1), np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(A @ t, -40, 40)))
            grad = A.T @ (weight * (p - y)) + 1e-2 * t
            step = np.linalg.solve((A * (weight * p * (1 - p))[:, None]).T @ A + 1e-2 * np.eye(2), grad)
            t = t - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = max(t[0] / 10, 1e-3), t[1]

    def score(self, X: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(X), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(X) + self.offset, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> Discriminant:
    """Fit on a bounded sample of labelled documents; what reaches the driver is their statistics."""
    sample = common.labelled_sample(docs, labels, "quality", SAMPLE_PER_CLASS, FOLDS, HELD, doc_id)

    def make():
        return lambda batch: [[statistics(t) for t in common.texts(batch, "text")]]

    rows = common.with_arrow(sample, [T.StructField("x", T.ArrayType(T.DoubleType()))], make, keep=["y"]).collect()
    X = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), len(STATISTICS))
    y = np.array([r["y"] for r in rows], np.int64)
    order = np.lexsort([*X.T, y])  # the sum of floats shall not depend on the order of arrival
    clear = common.clear_labels(labels, "doc_id", "quality").where(~common.held_out("doc_id", FOLDS, HELD))
    prior = clear.agg(F.avg("y")).first()[0]
    return Discriminant(X[order], y[order], prior)


def scored(docs: DataFrame, model: Discriminant, keep: list[str], text: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs' columns ``keep`` with a score (0 to 1) and a prediction (1 if score >= 0.5), called ``names``. Null text is empty; empty
    texts are scored like any other; repeated rows are scored alike; clashing columns give way."""
    source = docs.select(*dict.fromkeys([*keep, text]))

    def make():
        def compute(batch: pa.RecordBatch) -> list:
            X = np.array([statistics(t) for t in common.texts(batch, text)], np.float64).reshape(batch.num_rows, len(STATISTICS))
            s = model.score(X)
            return [s, (s >= 0.5).astype(np.int32)]

        return compute

    return common.with_arrow(source, [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())], make, keep=keep)


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with their own columns. Where not both classes are labelled,
    there is nothing to tell them by, and all stay."""
    common.prepare(docs.sparkSession)
    model = fit(docs, labels)
    if model.constant is not None:
        return docs
    names = ("_quality_score", "_quality_predicted")
    return scored(docs, model, docs.columns, names=names).where(F.col(names[1]) == 1).select(*docs.columns)
