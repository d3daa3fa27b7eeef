"""Gradient-boosted trees in numpy, for binary labels."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Trees whose levels each ask one question of all rows: (feature, threshold) per level, a value per leaf."""

    bias: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of label 1."""
        out = np.full(len(rows), self.bias)
        for features, thresholds, values in self.trees:
            leaf = np.zeros(len(rows), np.int64)
            for level, (f, t) in enumerate(zip(features, thresholds)):
                leaf |= (rows[:, f] > t).astype(np.int64) << level
            out += values[leaf]
        return out


def fit(rows: np.ndarray, labels: np.ndarray, n_trees: int = 60, depth: int = 5, rate: float = 0.25, bins: int = 24,
        ridge: float = 2.0) -> Boosted:
    """Newton boosting on the logistic loss with histograms; the features' quantiles are the thresholds."""
    n, n_features = rows.shape
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(edges[f], rows[:, f], "left") for f in range(n_features)]).astype(np.int64)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), [])
    score = np.full(n, model.bias)
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = labels - p, np.maximum(p * (1 - p), 1e-6)
        leaf = np.zeros(n, np.int64)
        chosen = []
        for level in range(depth):
            best = (-np.inf, 0, 0)
            leaves = 1 << level
            for f in range(n_features):
                if not len(edges[f]):
                    continue
                width = len(edges[f]) + 1
                at = leaf * width + binned[f]
                g = np.bincount(at, gradient, leaves * width).reshape(leaves, width)
                w = np.bincount(at, weight, leaves * width).reshape(leaves, width)
                left_g, left_w = g.cumsum(axis=1)[:, :-1], w.cumsum(axis=1)[:, :-1]
                right_g, right_w = g.sum(axis=1, keepdims=True) - left_g, w.sum(axis=1, keepdims=True) - left_w
                gain = (left_g ** 2 / (left_w + ridge) + right_g ** 2 / (right_w + ridge)).sum(axis=0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, k)
            _, f, k = best
            chosen.append((f, edges[f][k] if len(edges[f]) else np.inf))
            leaf |= (binned[f] > k).astype(np.int64) << level
        g, w = np.bincount(leaf, gradient, 1 << depth), np.bincount(leaf, weight, 1 << depth)
        values = rate * g / (w + ridge)
        score += values[leaf]
        model.trees.append((np.array([f for f, _ in chosen]), np.array([t for _, t in chosen]), values))
    return model
