"""Log-probability of candidate strings under a frame-by-symbol posterior, by the forward recursion in log space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def forward(frames: np.ndarray, symbols: list[int], blank: int = 0) -> float:
    """frames [time, symbols] of log posteriors; the log-probability of all paths that read as the symbols, by their
    number, divided by its length (at least one)."""
    path = [blank]
    for s in symbols:
        path += [s, blank]
    own = frames[:, path]
    skip = np.array([i >= 2 and path[i] != blank and path[i] != path[i - 2] for i in range(len(path))])
    a = np.full(len(path), -np.inf)
    a[: min(2, len(path))] = own[0, : min(2, len(path))]
    for t in range(1, len(frames)):
        one = np.concatenate(([-np.inf], a[:-1]))
        two = np.where(skip, np.concatenate(([-np.inf, -np.inf], a[:-2]))[: len(path)], -np.inf)
        a = np.logaddexp(np.logaddexp(a, one), two) + own[t]
    end = np.logaddexp(a[-1], a[-2]) if len(a) > 1 else a[-1]
    return float(end / max(1, len(symbols)))


def score(posterior: Column, width: int, symbols: Column) -> Column:
    """posterior: a flat array of scores, ``width`` symbols a frame, turned to log posteriors by softmax; symbols: the
    candidate. Null for posteriors that aren't whole frames."""

    @F.pandas_udf(T.DoubleType())
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for flat, own in parts:
            out = []
            for x, s in zip(flat, own, strict=True):
                if x is None or s is None or not len(x) or len(x) % width:
                    out.append(None)
                    continue
                m = np.asarray(x, float).reshape(-1, width)
                m = m - m.max(1, keepdims=True)
                out.append(forward(m - np.log(np.exp(m).sum(1, keepdims=True)), list(s)))
            yield pd.Series(out, dtype="float64")

    return run(posterior, symbols)
