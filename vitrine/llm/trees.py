"""Gradient-boosted trees for a yes/no label, on binned features, in numpy."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Depth-wise trees of logistic loss; ``predict`` gives probabilities."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, least: float = 8.0, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.least, self.ridge = trees, depth, rate, least, ridge

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "Boosted":
        n, features = x.shape
        self.cuts = []
        binned = np.empty((features, n), np.int64)
        for j in range(features):
            edges = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
            if len(edges) < 4:  # few values: cut between all of them
                values = np.unique(x[:, j])
                edges = (values[1:] + values[:-1]) / 2 if 1 < len(values) <= BINS else edges
            self.cuts.append(edges)
            binned[j] = np.searchsorted(edges, x[:, j], "left")
        share = np.clip((y * weight).sum() / weight.sum(), 0.01, 0.99)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(n, self.base)
        leaves = 1 << self.depth
        self.feature = np.zeros((self.trees, leaves), np.int64)
        self.edge = np.full((self.trees, leaves), np.inf)
        self.value = np.zeros((self.trees, leaves))
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = (y - p) * weight, p * (1 - p) * weight
            at = np.ones(n, np.int64)  # number of a node, its children 2i and 2i + 1
            for level in range(self.depth):
                first, count = 1 << level, 1 << level
                local = at - first
                best = np.zeros(count)
                pick, cut = np.zeros(count, np.int64), np.full(count, BINS)
                for j in range(features):
                    if not len(self.cuts[j]):
                        continue
                    slot = local * BINS + binned[j]
                    g = np.bincount(slot, grad, count * BINS).reshape(count, BINS).cumsum(1)
                    h = np.bincount(slot, hess, count * BINS).reshape(count, BINS).cumsum(1)
                    gl, hl = g[:, :-1], h[:, :-1]
                    gr, hr = g[:, -1:] - gl, h[:, -1:] - hl
                    gain = (gl ** 2 / (hl + self.ridge) + gr ** 2 / (hr + self.ridge)
                            - g[:, -1:] ** 2 / (h[:, -1:] + self.ridge))
                    gain[(hl < self.least / 8) | (hr < self.least / 8)] = 0
                    where = gain.argmax(1)
                    top = gain[np.arange(count), where]
                    better = top > best + 1e-9
                    best[better], pick[better], cut[better] = top[better], j, where[better]
                for i in range(count):
                    if cut[i] < len(self.cuts[pick[i]]):
                        self.feature[t, first + i], self.edge[t, first + i] = pick[i], self.cuts[pick[i]][cut[i]]
                at = 2 * at + (x[np.arange(n), self.feature[t, at]] > self.edge[t, at])
            leaf = at - leaves
            g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
            self.value[t] = self.rate * g / (h + self.ridge)
            score += self.value[t, leaf]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        row = np.arange(len(x))
        for t in range(self.trees):
            at = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + (x[row, self.feature[t, at]] > self.edge[t, at])
            score += self.value[t, at - (1 << self.depth)]
        return 1 / (1 + np.exp(-score))
