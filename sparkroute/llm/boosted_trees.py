"""Gradient-boosted trees for a bounded training sample, small enough to travel in a task's closure."""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    """Logistic boosting with histogram splits. A tree is an array of (feature, bound, left, right, value)."""

    def __init__(self, n_trees: int = 60, depth: int = 4, rate: float = 0.2, penalty: float = 1.0):
        self.n_trees, self.depth, self.rate, self.penalty = n_trees, depth, rate, penalty
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T, strict=True)], 1)
        share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.base)
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-margin))
            tree: list[tuple] = []
            self._grow(tree, binned, cuts, weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6), np.arange(len(y)), 0, margin)
            self.trees.append(tree)
        return self

    def _grow(self, tree, binned, cuts, slope, curve, rows, level, margin) -> int:
        here = len(tree)
        g, h = slope[rows].sum(), curve[rows].sum()
        value = self.rate * g / (h + self.penalty)
        tree.append((-1, 0.0, -1, -1, value))
        best = (1e-6, None, None)
        if level < self.depth and len(rows) > 1:
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                gs = np.cumsum(np.bincount(binned[rows, f], slope[rows], len(cut) + 1))[:-1]
                hs = np.cumsum(np.bincount(binned[rows, f], curve[rows], len(cut) + 1))[:-1]
                gain = gs**2 / (hs + self.penalty) + (g - gs) ** 2 / (h - hs + self.penalty) - g**2 / (h + self.penalty)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], f, i)
        if best[1] is None:
            margin[rows] += value
            return here
        _, f, i = best
        low = binned[rows, f] <= i
        left = self._grow(tree, binned, cuts, slope, curve, rows[low], level + 1, margin)
        right = self._grow(tree, binned, cuts, slope, curve, rows[~low], level + 1, margin)
        tree[here] = (f, float(cuts[f][i]), left, right, 0.0)
        return here

    def arrays(self) -> list[tuple[np.ndarray, ...]]:
        return [tuple(np.array(c) for c in zip(*tree, strict=True)) for tree in self.trees]

    def margins(self, x: np.ndarray, arrays: list | None = None) -> np.ndarray:
        """Log odds of each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, bound, left, right, value in arrays or self.arrays():
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                f = feature[at]
                inner = f >= 0
                go = np.where(x[rows, np.maximum(f, 0)] <= bound[at], left[at], right[at])
                at = np.where(inner, go, at)
            out += value[at]
        return out
