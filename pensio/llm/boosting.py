"""Gradient-boosted trees for a bounded training set that fits the driver; scoring runs in tasks."""

from __future__ import annotations

import numpy as np


def _splits(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]


def _tree(binned, sizes, grad, hess, depth, ridge):
    """(feature, bin, left, right, value) rows of one tree; a leaf has feature -1."""
    nodes = []

    def grow(rows, level):
        at = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        nodes.append([-1, 0, 0, 0, -g / (h + ridge)])
        if level == depth or len(rows) < 8:
            return at
        best = (1e-6, None, None)
        for j, size in enumerate(sizes):
            own = binned[rows, j]
            gl = np.cumsum(np.bincount(own, grad[rows], size))[:-1]
            hl = np.cumsum(np.bincount(own, hess[rows], size))[:-1]
            if not len(gl):
                continue
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            gain[(hl < 1e-3) | (h - hl < 1e-3)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], j, k)
        if best[1] is not None:
            _, j, k = best
            low = binned[rows, j] <= k
            nodes[at][:2] = j, k
            nodes[at][2] = grow(rows[low], level + 1)
            nodes[at][3] = grow(rows[~low], level + 1)
        return at

    grow(np.arange(len(grad)), 0)
    return np.array(nodes)


class Trees:
    """Logistic boosting with small trees over binned features."""

    def __init__(self, x, y, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0):
        x, y = np.asarray(x, float), np.asarray(y, float)
        self.cuts, self.trees, self.rate = _splits(x, bins), [], rate
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        binned = self._bin(x)
        sizes = [len(c) + 1 for c in self.cuts]
        margin = np.full(len(y), self.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = _tree(binned, sizes, p - y, p * (1 - p), depth, ridge)
            self.trees.append(tree)
            margin += rate * self._walk(tree, binned)

    def _bin(self, x):
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)

    @staticmethod
    def _walk(tree, binned):
        at = np.zeros(len(binned), int)
        rows = np.arange(len(binned))
        while True:
            feature = tree[at, 0].astype(int)
            inner = feature >= 0
            if not inner.any():
                return tree[at, 4]
            low = binned[rows, np.maximum(feature, 0)] <= tree[at, 1]
            at = np.where(inner, np.where(low, tree[at, 2], tree[at, 3]).astype(int), at)

    def probability(self, x) -> np.ndarray:
        binned = self._bin(np.asarray(x, float))
        margin = self.base + self.rate * sum(self._walk(t, binned) for t in self.trees)
        return 1 / (1 + np.exp(-margin))
