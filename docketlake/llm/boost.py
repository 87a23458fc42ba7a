"""Gradient-boosted trees for small feature sets, in numpy."""

from __future__ import annotations

import numpy as np


class Boost:
    """Logistic boosting of depth-limited trees over binned features.

    ``fit`` takes a bounded training matrix; the fitted object is a few small
    arrays and is sent to workers as it is.
    """

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, least: int = 8):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least
        self.edges: list[np.ndarray] = []
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Boost:
        x, y = np.asarray(x, float), np.asarray(y, float)
        w = np.ones(len(y)) if weight is None else np.asarray(weight, float)
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned, width = self._binned(x), self.bins + 1
        share = np.clip((w * y).sum() / w.sum(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        features = x.shape[1]
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = w * (y - p), w * np.maximum(p * (1 - p), 1e-6)
            size = 2 ** (self.depth + 1) - 1
            feature, cut, value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
            at = np.zeros(len(y), np.int64)
            for node in range(size):
                rows = np.flatnonzero(at == node)
                if not len(rows):
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                value[node] = self.rate * gs / (hs + 1.0)
                if node >= 2**self.depth - 1 or len(rows) < 2 * self.least:
                    continue
                best = (1e-3, -1, 0)
                for f in range(features):
                    b = binned[rows, f]
                    gl = np.cumsum(np.bincount(b, g[rows], width))[:-1]
                    hl = np.cumsum(np.bincount(b, h[rows], width))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=width))[:-1]
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    gain[(nl < self.least) | (len(rows) - nl < self.least)] = -1
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k)
                if best[1] >= 0:
                    feature[node], cut[node] = best[1], best[2]
                    at[rows] = 2 * node + 1 + (binned[rows, best[1]] > best[2])
            self.nodes.append((feature, cut, value))
            score += value[at]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The chance of the positive class for each row."""
        x = np.asarray(x, float)
        if not len(x):
            return np.zeros(0)
        binned = self._binned(x)
        score = np.full(len(x), self.base)
        each = np.arange(len(x))
        for feature, cut, value in self.nodes:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                at = np.where(f >= 0, 2 * at + 1 + (binned[each, np.maximum(f, 0)] > cut[at]), at)
            score += value[at]
        return 1 / (1 + np.exp(-score))
