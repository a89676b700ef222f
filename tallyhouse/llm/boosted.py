"""Small gradient-boosted trees for tasks: fitted on a bounded sample, evaluated over arrays."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Binary classification with logistic loss; splits are chosen among quantiles of each feature."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 32, least: int = 10):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least
        self.base, self.nodes = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        self.base = float(np.log(share / (1 - share)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])] if len(x) else []
        codes = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1) if len(x) else x
        margin = np.full(len(x), self.base)
        for _ in range(self.trees if len(x) else 0):
            p = 1 / (1 + np.exp(-margin))
            gradient, weight = y - p, p * (1 - p)
            tree: list = []
            self._grow(tree, codes, cuts, gradient, weight, np.arange(len(x)), self.depth, margin)
            self.nodes.append(self._packed(tree))
        return self

    def _grow(self, tree, codes, cuts, gradient, weight, rows, depth, margin) -> int:
        at = len(tree)
        g, h = gradient[rows].sum(), weight[rows].sum()
        value = self.rate * g / (h + 1.0)
        tree.append([-1, 0.0, at, at, value])
        best = (1e-6, -1, 0)
        if depth and len(rows) >= 2 * self.least:
            for j, cut in enumerate(cuts):
                if not len(cut):
                    continue
                n = len(cut) + 1
                code = codes[rows, j]
                gs = np.cumsum(np.bincount(code, gradient[rows], n))[:-1]
                hs = np.cumsum(np.bincount(code, weight[rows], n))[:-1]
                count = np.cumsum(np.bincount(code, minlength=n))[:-1]
                gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                gain[(count < self.least) | (len(rows) - count < self.least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], j, k)
        if best[1] < 0:
            margin[rows] += value
            return at
        _, j, k = best
        left = codes[rows, j] <= k
        tree[at][:2] = [j, float(cuts[j][k])]
        tree[at][2] = self._grow(tree, codes, cuts, gradient, weight, rows[left], depth - 1, margin)
        tree[at][3] = self._grow(tree, codes, cuts, gradient, weight, rows[~left], depth - 1, margin)
        return at

    @staticmethod
    def _packed(tree: list) -> tuple[np.ndarray, ...]:
        columns = list(zip(*tree, strict=True))
        return (np.array(columns[0]), np.array(columns[1]), np.array(columns[2]), np.array(columns[3]), np.array(columns[4]))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        margin = np.full(len(x), self.base)
        every = np.arange(len(x))
        for feature, cut, left, right, value in self.nodes:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                goes_left = x[every, np.maximum(f, 0)] <= cut[at]
                at = np.where(f < 0, at, np.where(goes_left, left[at], right[at]))
            margin += value[at]
        return 1 / (1 + np.exp(-margin))
