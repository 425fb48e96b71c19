"""Gradient-boosted trees with logistic loss, in numpy, for small training tables."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of depth ``depth`` as flat arrays: inner nodes in level order, then leaf values."""

    def __init__(self, depth: int = 3, rounds: int = 60, rate: float = 0.2, least: int = 4):
        self.depth, self.rounds, self.rate, self.least = depth, rounds, rate, least
        self.base = 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, rows: np.ndarray, labels: np.ndarray) -> BoostedTrees:
        share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        bounds = [(np.unique(c)[1:] + np.unique(c)[:-1]) / 2 for c in rows.T]
        score = np.full(len(rows), self.base)
        for _ in range(self.rounds):
            chance = 1 / (1 + np.exp(-score))
            slope, weight = labels - chance, chance * (1 - chance)
            tree = self._grown(rows, slope, weight, bounds)
            self.trees.append(tree)
            score += self._tree(tree, rows)
        return self

    def _grown(self, rows, slope, weight, bounds):
        inner = (1 << self.depth) - 1
        feature, bound, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        place = np.zeros(len(rows), np.int64)
        for node in range(inner):
            mine = np.flatnonzero(place == node)
            best = 1e-6
            if len(mine) >= 2 * self.least:
                g, h = slope[mine], weight[mine]
                whole = g.sum() ** 2 / (h.sum() + 1)
                for f, cuts in enumerate(bounds):
                    for cut in cuts:
                        below = rows[mine, f] < cut
                        n = int(below.sum())
                        if self.least <= n <= len(mine) - self.least:
                            gain = (g[below].sum() ** 2 / (h[below].sum() + 1) + g[~below].sum() ** 2 / (h[~below].sum() + 1) - whole)
                            if gain > best + 1e-9:
                                best, feature[node], bound[node] = gain, f, cut
            place[mine] = 2 * node + 1 + (rows[mine, feature[node]] >= bound[node])
        for k in range(inner + 1):
            mine = place == inner + k
            leaf[k] = self.rate * slope[mine].sum() / (weight[mine].sum() + 1)
        return feature, bound, leaf

    @staticmethod
    def _tree(tree, rows: np.ndarray) -> np.ndarray:
        feature, bound, leaf = tree
        place = np.zeros(len(rows), np.int64)
        each = np.arange(len(rows))
        while len(rows) and place[0] < len(feature):
            place = 2 * place + 1 + (rows[each, feature[place]] >= bound[place])
        return leaf[place - len(feature)]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        total = np.full(len(rows), self.base)
        for tree in self.trees:
            total += self._tree(tree, rows)
        return total


def calibrated(scores: np.ndarray, labels: np.ndarray, precision: float) -> float:
    """The lowest score at or above which held-out rows reach ``precision``; infinite if none do."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(labels[order]) / np.arange(1, len(order) + 1)
    last = np.append(np.diff(scores[order]) != 0, True)  # equal scores are chosen together
    good = np.flatnonzero((right >= precision) & last)
    return float(scores[order[good[-1]]]) if len(good) else float("inf")
