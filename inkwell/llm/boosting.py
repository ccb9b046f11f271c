"""Gradient-boosted regression trees on the logistic loss, in numpy, for tables of a few thousand rows."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees as flat arrays: feature, threshold, and the leaf values of a complete tree of the given depth."""

    def __init__(self, depth: int, rate: float):
        self.depth, self.rate, self.base = depth, rate, 0.0
        self.features: list[np.ndarray] = []
        self.cuts: list[np.ndarray] = []
        self.leaves: list[np.ndarray] = []

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, c, leaf in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += self.rate * leaf[node - (2**self.depth - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[int, float]:
    best, where = 1e-9, (0, np.inf)
    total = g.sum() ** 2 / (h.sum() + ridge)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, gs, hs = x[order, f], np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
        gain = gs**2 / (hs + ridge) + (g.sum() - gs) ** 2 / (h.sum() - hs + ridge) - total
        gain[v[1:] == v[:-1]] = 0
        if len(gain) and gain.max() > best:
            k = int(gain.argmax())
            best, where = gain[k], (f, (v[k] + v[k + 1]) / 2)
    return where


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    """x (n, features), y 0 or 1. Second-order boosting; equal gains go to the first feature and cut."""
    model = Boosted(depth, rate)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.base = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        inner = 2**depth - 1
        f, c, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(node == k)
                if len(rows) > 1:
                    f[k], c[k] = _split(x[rows], g[rows], h[rows], ridge)
            node = 2 * node + 1 + (x[np.arange(len(y)), f[node]] > c[node])
        for k in range(inner + 1):
            rows = node == k + inner
            leaf[k] = -g[rows].sum() / (h[rows].sum() + ridge)
        model.features.append(f)
        model.cuts.append(c)
        model.leaves.append(leaf)
        margin = margin + rate * leaf[node - inner]
    return model
