"""A small random forest in numpy, for a bounded training table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES = 40
DEPTH = 9
LEAF = 3


@dataclass(frozen=True)
class Tree:
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH + 1):
            inner = self.feature[at] >= 0
            low = x[np.arange(len(x)), np.maximum(self.feature[at], 0)] <= self.cut[at]
            at = np.where(inner, np.where(low, self.left[at], self.right[at]), at)
        return self.share[at]


def _best_cut(values: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The lowest weighted Gini impurity of a cut and where it is."""
    order = np.argsort(values, kind="stable")
    v, ones = values[order], np.cumsum(y[order])
    n, total = len(v), ones[-1]
    size = np.arange(1, n)
    ok = (v[1:] > v[:-1]) & (size >= LEAF) & (n - size >= LEAF)
    if not ok.any():
        return np.inf, 0.0
    a, b = ones[:-1], total - ones[:-1]
    impurity = a * (1 - a / size) + b * (1 - b / (n - size))
    i = int(np.argmin(np.where(ok, impurity, np.inf)))
    return float(impurity[i]), float((v[i] + v[i + 1]) / 2)


def _grow(x: np.ndarray, y: np.ndarray, random: np.random.RandomState) -> Tree:
    nodes: list[list] = []
    tries = max(1, int(np.sqrt(x.shape[1])) + 1)

    def add(rows: np.ndarray, depth: int) -> int:
        here = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y[rows].mean())])
        if depth < DEPTH and len(rows) >= 2 * LEAF and 0 < y[rows].sum() < len(rows):
            picked = random.permutation(x.shape[1])[:tries]
            cuts = [(*_best_cut(x[rows, f], y[rows]), f) for f in picked]
            impurity, cut, f = min(cuts)
            if np.isfinite(impurity):
                low = x[rows, f] <= cut
                left, right = add(rows[low], depth + 1), add(rows[~low], depth + 1)
                nodes[here][:4] = [f, cut, left, right]
        return here

    add(random.randint(0, len(y), len(y)), 0)
    feature, cut, left, right, share = (np.array(c) for c in zip(*nodes, strict=True))
    return Tree(feature, cut, left, right, share)


@dataclass(frozen=True)
class Forest:
    trees: tuple[Tree, ...]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of positive findings, averaged over the trees."""
        return np.mean([t.predict(x) for t in self.trees], axis=0) if len(x) else np.zeros(0)


def grow(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Forest:
    random = np.random.RandomState(seed)
    return Forest(tuple(_grow(x, y.astype(float), random) for _ in range(TREES)))
