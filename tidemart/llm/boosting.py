"""Gradient-boosted trees for two classes, on binned features. Fitted on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemart.llm.common import sigmoid

BINS = 32
LEAST_ROWS = 20


@dataclass(frozen=True)
class Boosted:
    """Trees as arrays: a node's children are 2i + 1 and 2i + 2; feature -1 goes left always."""

    start: float
    features: np.ndarray
    cuts: np.ndarray
    values: np.ndarray

    def chance(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.values.shape[1]))
        for feature, cut, value in zip(self.features, self.cuts, self.values):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                right = (feature[at] >= 0) & (x[rows, np.maximum(feature[at], 0)] > cut[at])
                at = 2 * at + 1 + right
            total += value[at - (2**depth - 1)]
        return sigmoid(total)


def fit(x: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2, ridge: float = 1.0) -> Boosted:
    """Second-order boosting of the logistic loss."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(width)]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    share = np.clip(labels.mean(), 1e-4, 1 - 1e-4)
    start = float(np.log(share / (1 - share)))
    scores = np.full(n, start)
    all_features, all_cuts, all_values = [], [], []
    for _ in range(trees):
        chance = sigmoid(scores)
        slope, bend = chance - labels, chance * (1 - chance)
        feature = np.full(2**depth - 1, -1)
        cut = np.zeros(2**depth - 1)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            place = at - first
            best = np.full(nodes, 1e-6)
            split_bin = np.zeros(nodes, np.int64)
            g_all, h_all = np.bincount(place, slope, nodes), np.bincount(place, bend, nodes)
            for f in range(width):
                key = place * BINS + binned[:, f]
                g = np.bincount(key, slope, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                h = np.bincount(key, bend, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                c = np.bincount(key, minlength=nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                g2, h2 = g_all[:, None] - g, h_all[:, None] - h
                gain = g**2 / (h + ridge) + g2**2 / (h2 + ridge) - (g_all**2 / (h_all + ridge))[:, None]
                gain[(c < LEAST_ROWS) | (c[:, -1:] - c < LEAST_ROWS)] = -1
                gain[:, len(edges[f]):] = -1
                top = gain.argmax(axis=1)
                better = gain[np.arange(nodes), top] > best
                best[better] = gain[better, top[better]]
                split_bin[better] = top[better]
                feature[first:first + nodes][better] = f
                for k in np.flatnonzero(better):
                    cut[first + k] = edges[f][top[k]]
            chosen = feature[at]
            right = (chosen >= 0) & (x[np.arange(n), np.maximum(chosen, 0)] > cut[at])
            at = 2 * at + 1 + right
        leaf = at - (2**depth - 1)
        value = -rate * np.bincount(leaf, slope, 2**depth) / (np.bincount(leaf, bend, 2**depth) + ridge)
        scores += value[leaf]
        all_features.append(feature)
        all_cuts.append(cut)
        all_values.append(value)
    return Boosted(start, np.array(all_features), np.array(all_cuts), np.array(all_values))
