"""Gradient-boosted trees in numpy, for models that are fitted here on small labelled samples.

Features are cut into at most `bins` bins at training quantiles; trees are
complete binary trees of fixed depth held in arrays, so prediction is a few
array look-ups per level for all rows at once. Logistic loss, second-order
leaf values. Fitting is deterministic.
"""

from __future__ import annotations

import numpy as np


class Boosted:
    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, smooth: float = 1.0, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.smooth, self.least = trees, depth, rate, bins, smooth, least

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Boosted:
        x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
        weight = np.ones(len(y)) if weight is None else np.asarray(weight, np.float64)
        n, m = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) for j in range(m)]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
        width = self.bins + 1
        p = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        score = np.full(n, self.start)
        inner = (1 << self.depth) - 1
        self.feature = np.zeros((self.trees, inner), np.int32)
        self.cut = np.full((self.trees, inner), np.inf)
        self.leaf = np.zeros((self.trees, 1 << self.depth))
        columns = np.arange(m)
        for t in range(self.trees):
            prob = 1 / (1 + np.exp(-score))
            g, h = weight * (y - prob), weight * np.maximum(prob * (1 - prob), 1e-6)
            node = np.zeros(n, np.int64)
            for d in range(self.depth):
                size = 1 << d
                flat = ((node - (size - 1))[:, None] * m + columns) * width + binned
                sums = [np.bincount(flat.ravel(), np.repeat(v, m), size * m * width).reshape(size, m, width).cumsum(2) for v in (g, h)]
                gl, hl = sums[0][:, :, :-1], sums[1][:, :, :-1]
                gt, ht = sums[0][:, :1, -1:], sums[1][:, :1, -1:]
                gr, hr = gt - gl, ht - hl
                gain = gl**2 / (hl + self.smooth) + gr**2 / (hr + self.smooth) - gt**2 / (ht + self.smooth)
                gain[(hl < self.least) | (hr < self.least)] = 0
                best = gain.reshape(size, -1).argmax(1)
                ok = gain.reshape(size, -1)[np.arange(size), best] > 1e-9
                f, b = best // (width - 1), best % (width - 1)
                for k in range(size):
                    if ok[k] and b[k] < len(cuts[f[k]]):
                        self.feature[t, size - 1 + k] = f[k]
                        self.cut[t, size - 1 + k] = cuts[f[k]][b[k]]
                node = 2 * node + 1 + (x[np.arange(n), self.feature[t, node]] > self.cut[t, node])
            at = node - inner
            gs, hs = np.bincount(at, g, inner + 1), np.bincount(at, h, inner + 1)
            self.leaf[t] = self.rate * gs / (hs + self.smooth)
            score += self.leaf[t, at]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float64)
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = (1 << self.depth) - 1
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, self.feature[t, node]] > self.cut[t, node])
            out += self.leaf[t, node - inner]
        return out


class Calibrated:
    """A boosted model with a slope and an offset (Platt) fitted on rows that the trees have not seen."""

    def __init__(self, model: Boosted):
        self.model, self.slope, self.offset = model, 1.0, 0.0

    def calibrate(self, x: np.ndarray, y: np.ndarray, rounds: int = 50) -> Calibrated:
        z, y = self.model.margin(x), np.asarray(y, np.float64)
        n1, n0 = y.sum(), len(y) - y.sum()
        goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-(self.slope * z + self.offset)))
            w, e = np.maximum(p * (1 - p), 1e-6), p - goal
            hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
            step = np.linalg.solve(hess, np.array([(e * z).sum() + 1e-3 * (self.slope - 1), e.sum()]))
            self.slope -= float(np.clip(step[0], -1, 1))
            self.offset -= float(np.clip(step[1], -1, 1))
            if abs(step).max() < 1e-8:
                break
        return self

    def prob(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.model.margin(x) + self.offset, -40, 40)))


def threshold(prob: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least threshold whose picks among these rows reach the precision."""
    order = np.argsort(-prob, kind="stable")
    hit = np.cumsum(np.asarray(y)[order])
    ok = np.flatnonzero(hit >= precision * np.arange(1, len(order) + 1))
    last = np.append(np.diff(prob[order]) != 0, True)  # ties stand or fall together
    ok = ok[last[ok]]
    return float(prob[order][ok[-1]]) if len(ok) else 1.1
