"""Gradient-boosted regression trees on a bounded sample, as arrays that apply to many rows at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Per tree and inner node a feature and a threshold, per leaf a value; all trees have one depth."""

    start: float
    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of the rows (one feature vector each)."""
        odds = np.full(len(rows), self.start)
        depth = self.features.shape[1].bit_length()
        at = np.arange(len(rows))
        for features, thresholds, leaves in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[at, features[node]] > thresholds[node])
            odds += leaves[node - self.features.shape[1]]
        return 1 / (1 + np.exp(-odds))


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 30, depth: int = 4, rate: float = 0.3, bins: int = 32) -> Trees:
    """Logistic boosting with second-order leaf values; splits are sought among quantiles."""
    inner = (1 << depth) - 1
    share = min(max(float(labels.mean()) if len(labels) else 0.5, 1e-3), 1 - 1e-3)
    made = Trees(float(np.log(share / (1 - share))), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    if not len(rows):
        return made
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(e, column) for e, column in zip(edges, rows.T)], 1)
    odds = np.full(len(rows), made.start)
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-odds))
        slope, curve = labels - chance, chance * (1 - chance)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            inside = node - first
            best = np.full(count, 1e-6)
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                place = inside * (bins + 1) + binned[:, f]
                g = np.bincount(place, slope, count * (bins + 1)).reshape(count, -1).cumsum(1)
                h = np.bincount(place, curve, count * (bins + 1)).reshape(count, -1).cumsum(1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                gain = gain[:, : len(edge)]
                top = gain.argmax(1)
                value = gain[np.arange(count), top]
                better = value > best
                best = np.where(better, value, best)
                made.features[tree, first : first + count][better] = f
                made.thresholds[tree, first : first + count][better] = edge[top][better]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), made.features[tree, node]] > made.thresholds[tree, node])
        leaf = node - inner
        made.leaves[tree] = rate * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, curve, inner + 1) + 1)
        odds += made.leaves[tree][leaf]
    return made
