"""Gradient-boosted regression trees for two classes, on binned features; small enough to fit on the driver."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic boosting of trees of depth ``depth``; features are cut at up to ``bins`` quantiles."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.25, bins: int = 24, least: int = 5, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least, self.ridge = trees, depth, rate, bins, least, ridge
        self.cuts: list[np.ndarray] = []
        self.forest: list[list[tuple[int, int, float]]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], 1).astype(np.int32)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        x = np.asarray(x, float)
        y = np.asarray(y, float)
        self.cuts = [np.unique(np.quantile(col, np.linspace(0, 1, self.bins + 1)[1:])) if len(np.unique(col)) > self.bins else (np.unique(col)[:-1] + np.unique(col)[1:]) / 2 for col in x.T]
        b = self._binned(x)
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        self.forest = []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            tree: list[tuple[int, int, float]] = [(-1, 0, 0.0)] * (2 ** (self.depth + 1))
            self._grow(tree, 1, np.arange(len(y)), b, grad, hess, 0)
            self.forest.append(tree)
            score += self._tree(tree, b)
        return self

    def _grow(self, tree, node, rows, b, grad, hess, depth) -> None:
        g, h = grad[rows].sum(), hess[rows].sum()
        tree[node] = (-1, 0, self.rate * g / (h + self.ridge))
        if depth == self.depth or len(rows) < 2 * self.least:
            return
        best = (1e-6, -1, 0)
        for j, cut in enumerate(self.cuts):
            if not len(cut):
                continue
            at = b[rows, j]
            gs = np.cumsum(np.bincount(at, grad[rows], len(cut) + 1))[:-1]
            hs = np.cumsum(np.bincount(at, hess[rows], len(cut) + 1))[:-1]
            ns = np.cumsum(np.bincount(at, minlength=len(cut) + 1))[:-1]
            gain = gs**2 / (hs + self.ridge) + (g - gs) ** 2 / (h - hs + self.ridge) - g**2 / (h + self.ridge)
            gain[(ns < self.least) | (len(rows) - ns < self.least)] = -1
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), j, k)
        if best[1] < 0:
            return
        _, j, k = best
        left = b[rows, j] <= k
        tree[node] = (j, k, 0.0)
        self._grow(tree, 2 * node, rows[left], b, grad, hess, depth + 1)
        self._grow(tree, 2 * node + 1, rows[~left], b, grad, hess, depth + 1)

    @staticmethod
    def _tree(tree, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(b))

        def go(node, rows):
            j, k, value = tree[node]
            if j < 0:
                out[rows] = value
                return
            left = b[rows, j] <= k
            go(2 * node, rows[left])
            go(2 * node + 1, rows[~left])

        go(1, np.arange(len(b)))
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        if not len(x):
            return np.zeros(0)
        b = self._binned(np.asarray(x, float))
        return 1 / (1 + np.exp(-(self.base + sum(self._tree(t, b) for t in self.forest))))
