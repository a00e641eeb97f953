"""Histogram gradient-boosted trees for two classes, in numpy.

Features are cut into bins at quantiles once; a tree grows level by level from histograms of gradients and
curvatures over the bins. Trees are complete to their depth and flattened into arrays (feature, threshold,
leaf value), so that a batch is scored by indexing alone: at each level all rows step in all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """feature and threshold: (trees, 2**depth - 1); value: (trees, 2**depth); base: log odds; a, b: calibration of the log odds."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    a: float = 1.0
    b: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        raw = self.a * self.raw(x) + self.b
        return 1 / (1 + np.exp(-np.clip(raw, -35, 35)))

    def raw(self, x: np.ndarray) -> np.ndarray:
        trees, leaves = self.value.shape
        if not trees or not len(x):
            return np.full(len(x), self.base)
        out = np.empty(len(x))
        every = np.arange(trees)
        for at in range(0, len(x), 4096):
            rows = x[at : at + 4096]
            node = np.zeros((len(rows), trees), np.int64)
            for _ in range(leaves.bit_length() - 1):
                right = np.take_along_axis(rows, self.feature[every, node], axis=1) > self.threshold[every, node]
                node = 2 * node + 1 + right
            out[at : at + 4096] = self.value[every, node - (leaves - 1)].sum(axis=1)
        return out + self.base


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.12, bins: int = 64, l2: float = 1.0, least: float = 1.0, calibrate: bool = True) -> Forest:
    """Trees for labels 0 and 1; a fifth of the rows calibrates the scores (Platt). Less than two classes: a constant."""
    n, k = x.shape
    size = 1 << depth
    rate_of_ones = float(y.mean()) if n else 0.5
    base = float(np.log((rate_of_ones * n + 0.5) / ((1 - rate_of_ones) * n + 0.5)))
    none = Forest(np.zeros((0, size - 1), np.int64), np.zeros((0, size - 1)), np.zeros((0, size)), base)
    if n < 10 or y.min() == y.max():
        return none
    order = np.random.default_rng(5).permutation(n)
    back = order[: n // 5] if calibrate and n >= 100 else order[:0]
    own = order[len(back) :]
    cuts = [np.unique(np.quantile(x[own, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(cuts[j], x[own, j], side="left") for j in range(k)], axis=1)
    ys = y[own].astype(float)
    raw = np.full(len(own), base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - ys, p * (1 - p)
        feature, threshold = np.zeros(size - 1, np.int64), np.full(size - 1, np.inf)
        node = np.zeros(len(own), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-6)
            for j in range(k):
                if not len(cuts[j]):
                    continue
                at = (node - first) * bins + binned[:, j]
                sg = np.bincount(at, g, width * bins).reshape(width, bins).cumsum(axis=1)
                sh = np.bincount(at, h, width * bins).reshape(width, bins).cumsum(axis=1)
                tg, th = sg[:, -1:], sh[:, -1:]
                m = len(cuts[j])
                lg, lh = sg[:, :m], sh[:, :m]
                gain = lg**2 / (lh + l2) + (tg - lg) ** 2 / (th - lh + l2) - tg**2 / (th + l2)
                gain = np.where((lh >= least) & (th - lh >= least), gain, 0)
                top = gain.argmax(axis=1)
                won = gain[np.arange(width), top] > best
                best = np.where(won, gain[np.arange(width), top], best)
                feature[first : first + width] = np.where(won, j, feature[first : first + width])
                threshold[first : first + width] = np.where(won, cuts[j][top], threshold[first : first + width])
            node = 2 * node + 1 + (x[own, feature[node]] > threshold[node])
        leaf = node - (size - 1)
        value = -rate * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + l2)
        raw = raw + value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    out = Forest(np.array(features), np.array(thresholds), np.array(values), base)
    if len(back) < 20 or y[back].min() == y[back].max():
        return out
    # Platt scaling by Newton steps on the rows kept back, with smoothed targets.
    z, t = out.raw(x[back]), np.where(y[back] > 0, (y[back].sum() + 1) / (y[back].sum() + 2), 1 / ((1 - y[back]).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))
        w = p * (1 - p)
        gradient = np.array([((p - t) * z).sum() + 1e-3 * (a - 1), (p - t).sum()])
        curve = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return Forest(out.feature, out.threshold, out.value, base, max(float(a), 0.1), float(b))
