"""Gradient-boosted trees on a bounded training sample, with histogram splits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class BoostedTrees:
    """Complete binary trees of equal depth: per tree the feature and cut of each inner node, and leaf values."""

    start: float
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray
    leaves: np.ndarray  # trees x 2**depth

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 for every row."""
        out = np.full(len(x), self.start)
        rows, depth = np.arange(len(x)), int(np.log2(self.leaves.shape[1]))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - (leaf.shape[0] - 1)]
        return out


def fit_boosted(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, penalty: float = 1.0) -> BoostedTrees:
    """Logistic loss, second-order leaf values; cuts are quantiles of each feature."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    score, inner, width = np.full(len(y), start), 2**depth - 1, bins
    offset = (np.arange(x.shape[1]) * width)[None, :]
    all_features, all_cuts, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut, at = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                if len(rows) > 1:
                    flat = (binned[rows] + offset).ravel()
                    repeat = x.shape[1]
                    g = np.bincount(flat, np.repeat(grad[rows], repeat), x.shape[1] * width).reshape(-1, width).cumsum(axis=1)
                    h = np.bincount(flat, np.repeat(hess[rows], repeat), x.shape[1] * width).reshape(-1, width).cumsum(axis=1)
                    total_g, total_h = g[0, -1], h[0, -1]
                    gain = g**2 / (h + penalty) + (total_g - g) ** 2 / (total_h - h + penalty) - total_g**2 / (total_h + penalty)
                    best, place = np.unravel_index(int(gain[:, :-1].argmax()), (x.shape[1], width - 1))
                    if gain[best, place] > 1e-6 and place < len(edges[best]):
                        feature[node], cut[node] = best, edges[best][place]
                at[rows] = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        leaf_at = at - inner
        g, h = np.bincount(leaf_at, grad, 2**depth), np.bincount(leaf_at, hess, 2**depth)
        leaves = -rate * g / (h + penalty)
        score = score + leaves[leaf_at]
        all_features.append(feature)
        all_cuts.append(cut)
        all_leaves.append(leaves)
    return BoostedTrees(start, np.array(all_features), np.array(all_cuts), np.array(all_leaves))
