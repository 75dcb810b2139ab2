"""Linear-chain conditional random fields in numpy: forward-backward, Viterbi and training over padded batches."""

from __future__ import annotations

import numpy as np


class Ragged:
    """Rows of feature buckets, each of its own length (one bucket at least)."""

    def __init__(self, rows: list):
        self.lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        self.flat = np.fromiter((x for r in rows for x in r), np.int64, int(self.lengths.sum()))
        self.ends = np.cumsum(self.lengths)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of the given rows, one after another, and where each row starts."""
        lengths = self.lengths[rows]
        starts = np.cumsum(lengths) - lengths
        return self.flat[np.arange(int(lengths.sum())) - np.repeat(starts, lengths) + np.repeat(self.ends[rows] - lengths, lengths)], starts

    def sums(self, weights: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """[rows, labels]: the sum of each row's weights, in parts of about a million buckets."""
        rows = np.arange(len(self.lengths)) if rows is None else rows
        out = np.zeros((len(rows), weights.shape[1]), np.float32)
        part = np.cumsum(self.lengths[rows]) >> 20
        for own in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(part)) + 1) if len(rows) else []:
            flat, starts = self.of(rows[own])
            out[own] = np.add.reduceat(weights[flat], starts)
        return out


def emissions(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """[tokens, labels] log scores of tokens given as rows of feature buckets; bucket 0 counts nothing."""
    out = np.zeros((len(features), weights.shape[1]), np.float32)
    for i in range(0, len(features), 1 << 14):
        out[i : i + (1 << 14)] = weights[features[i : i + (1 << 14)]].sum(1)
    return out


def transfers(E: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """E [time, batch, labels] log emissions -> [batch, labels, labels]: what each sequence makes, up to a factor, of a
    vector of weights before its first step's emission: the weights after its last step's."""
    e = np.exp(E.astype(np.float64) - E.max(2, keepdims=True))
    P = np.exp(trans - trans.max()).astype(np.float64)
    M = np.eye(E.shape[2]) * e[0][:, None, :]
    for t in range(1, len(e)):
        now = (M @ P) * e[t][:, None, :]
        M = np.where((t < lengths)[:, None, None], now / now.max((1, 2), keepdims=True), M)
    return M


def carried(M: np.ndarray, cuts: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transfers M of blocks, so many for each chain one after another -> (weights before each block, weights that what
    follows it gives the labels of its last step), so that each block can be read by itself as a part of its chain."""
    P = np.exp(trans - trans.max()).astype(np.float64)
    first, last = np.cumsum(cuts) - cuts, np.cumsum(cuts) - 1
    enter, leave = np.tile(np.exp(start - start.max()).astype(np.float64), (len(M), 1)), np.ones((len(M), M.shape[1]))
    for j in range(int(cuts.max(initial=1)) - 1):
        on = cuts > j + 1
        at = first[on] + j
        now = (enter[at][:, None] @ M[at])[:, 0] @ P
        enter[at + 1] = now / now.sum(1, keepdims=True)
        at = last[on] - j
        now = (M[at] @ leave[at][:, :, None])[:, :, 0] @ P.T
        leave[at - 1] = now / now.sum(1, keepdims=True)
    return enter, leave


def posteriors(E: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray, pairs: bool = False, enter: np.ndarray | None = None, leave: np.ndarray | None = None):
    """E [time, batch, labels] log emissions of sequences of so many steps -> label probabilities of the same shape,
    0 beyond the end, and with ``pairs`` the expected number of each transition. Scaled at each step, so it neither
    overflows nor vanishes. ``enter`` and ``leave`` [batch, labels] are given where the sequences are parts of chains."""
    T, B, K = E.shape
    e = np.exp(E - E.max(2, keepdims=True))
    P = np.exp(trans - trans.max())
    live = np.arange(T)[:, None] < lengths[None]
    a, scale = np.empty_like(e), np.ones((T, B, 1), e.dtype)
    now = (np.exp(start - start.max()) if enter is None else enter.astype(e.dtype)) * e[0]
    scale[0] = now.sum(1, keepdims=True)
    a[0] = now / scale[0]
    for t in range(1, T):
        now = (a[t - 1] @ P) * e[t]
        total = now.sum(1, keepdims=True)
        scale[t] = np.where(live[t][:, None], total, 1)
        a[t] = np.where(live[t][:, None], now / total, a[t - 1])
    b = np.ones((B, K), e.dtype) if leave is None else leave.astype(e.dtype)
    gamma = np.empty_like(e)
    gamma[T - 1] = a[T - 1] * b
    counts = np.zeros((K, K))
    for t in range(T - 1, 0, -1):
        on = live[t][:, None]
        ahead = np.where(on, e[t] * b / scale[t], 0)
        if pairs:
            counts += (a[t - 1].T @ ahead) * P
        b = np.where(on, ahead @ P.T, b)
        gamma[t - 1] = a[t - 1] * b
    gamma *= live[:, :, None]
    gamma /= np.maximum(gamma.sum(2, keepdims=True), 1e-30)
    return (gamma, counts) if pairs else gamma


def viterbi(E: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best labels [time, batch]; those beyond a sequence's end mean nothing. Ties go to the first label."""
    T, B, K = E.shape
    best = start + E[0]
    back = np.zeros((T, B, K), np.int16)
    for t in range(1, T):
        ways = best[:, :, None] + trans[None]
        back[t] = ways.argmax(1)
        step = ways.max(1) + E[t]
        on = (t < lengths)[:, None]
        back[t] = np.where(on, back[t], np.arange(K))
        best = np.where(on, step, best)
    out = np.zeros((T, B), np.int64)
    out[T - 1] = best.argmax(1)
    for t in range(T - 1, 0, -1):
        out[t - 1] = back[t, np.arange(B), out[t]]
    return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """[time, batch] of integer rows, padded with 0, and their lengths."""
    lengths = np.array([len(r) for r in rows])
    out = np.zeros((int(lengths.max()), len(rows)), np.int64)
    for i, r in enumerate(rows):
        out[: len(r), i] = r
    return out, lengths


def train(features: Ragged, sequences: list[tuple[np.ndarray, np.ndarray]], buckets: int, labels: int, epochs: int, batch: int = 64, rate: float = 0.1, ridge: float = 1e-4, seed: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, transitions, start) that make the labels of the sequences likely; Adagrad on the likelihood.

    features: a row of buckets for each distinct token; sequences: token numbers and labels.
    """
    r = np.random.default_rng(seed)
    W, A, s = np.zeros((buckets, labels), np.float32), np.zeros((labels, labels)), np.zeros(labels)
    hW, hA, hs = np.full((buckets, labels), 1e-2, np.float32), np.full((labels, labels), 1e-2), np.full(labels, 1e-2)
    for _ in range(epochs):
        order = r.permutation(len(sequences))
        for k in range(0, len(order), batch):
            tokens, lengths = padded([sequences[i][0] for i in order[k : k + batch]])
            gold, _ = padded([sequences[i][1] for i in order[k : k + batch]])
            live = np.arange(len(tokens))[:, None] < lengths
            used, back = np.unique(tokens, return_inverse=True)
            E = features.sums(W, used)[back.reshape(tokens.shape)]
            gamma, counts = posteriors(E.astype(np.float64), lengths, A, s, pairs=True)
            d = gamma - np.eye(labels)[gold] * live[:, :, None]
            dU = np.zeros((len(used), labels))
            np.add.at(dU, back.reshape(-1), d.reshape(-1, labels))
            flat, _ = features.of(used)
            own, where = np.unique(flat, return_inverse=True)
            dW = np.zeros((len(own), labels), np.float32)
            np.add.at(dW, where, np.repeat(dU.astype(np.float32), features.lengths[used], axis=0))
            dW = dW / len(lengths) + ridge * W[own]
            hW[own] += dW**2
            W[own] -= rate * dW / np.sqrt(hW[own])
            seen = np.zeros((labels, labels))
            both = live[1:] & live[:-1]
            np.add.at(seen, (gold[:-1][both], gold[1:][both]), 1)
            dA = (counts - seen) / len(lengths) + ridge * A
            hA += dA**2
            A -= rate * dA / np.sqrt(hA)
            ds = d[0].sum(0) / len(lengths) + ridge * s
            hs += ds**2
            s -= rate * ds / np.sqrt(hs)
    return W, A, s
