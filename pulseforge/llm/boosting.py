"""Gradient-boosted trees for a yes-or-no label, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Trees of equal depth as heaps: ``feature`` (-1: go left), ``limit``, ``leaf``."""

    prior: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out, every = np.full(len(x), self.prior), np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                f = feature[at]
                at = 2 * at + 1 + ((f >= 0) & (x[every, np.maximum(f, 0)] > limit[at]))
            out += leaf[at - (len(leaf) - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 50, depth: int = 4, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Fit by Newton steps on the logistic loss."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left").astype(np.uint8) for c, v in zip(cuts, x.T)])
    width, (n, features) = bins + 1, x.shape
    # Features of two values need no counting: a product has their sums.
    two = binned.max(axis=0) <= 1
    ones, many = binned[:, two].astype(np.float32), np.flatnonzero(~two)
    flat = binned[:, many] + np.arange(len(many)) * width
    mean = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    prior = float(np.log(mean / (1 - mean)))
    score, made = np.full(n, prior), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), weight * p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        feature, limit = np.full(2**depth - 1, -1), np.zeros(2**depth - 1)
        for node in range(2**depth - 1):
            rows = np.flatnonzero(at == node)
            if len(rows) > 10:
                sums = [np.zeros((features, width)) for _ in range(2)]
                for s, v in zip(sums, (g[rows], h[rows])):
                    s[many] = np.bincount(flat[rows].ravel(), np.repeat(v, len(many)), len(many) * width).reshape(len(many), width)
                    s[two, 1] = v.astype(np.float32) @ ones[rows]
                    s[two, 0] = v.sum() - s[two, 1]
                left_g, left_h = np.cumsum(sums[0], axis=1), np.cumsum(sums[1], axis=1)
                all_g, all_h = left_g[0, -1], left_h[0, -1]
                gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
                gain[(left_h < 1e-3) | (all_h - left_h < 1e-3)] = 0
                best = int(gain.argmax())
                f, b = divmod(best, width)
                if gain[f, b] > 1e-6 and b < len(cuts[f]):
                    feature[node], limit[node] = f, cuts[f][b]
                    at[rows] = 2 * node + 1 + (binned[rows, f] > b)
                    continue
            at[rows] = 2 * node + 1
        at -= 2**depth - 1
        leaf = rate * np.bincount(at, g, 2**depth) / (np.bincount(at, h, 2**depth) + ridge)
        score += leaf[at]
        made.append((feature, limit, leaf))
    return Trees(prior, *(np.array(a) for a in zip(*made)))
