"""Histogram gradient-boosted trees with logistic loss, stored as flat arrays.

Every tree is a complete binary tree of the same depth, so a row walks it by
``node = 2 * node + 1 + (x > threshold)`` and all rows of a batch take each step
together.  A node that is not worth splitting sends all rows to the left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """``feature`` and ``threshold`` by tree and inner node, ``value`` by tree and leaf."""

    start: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - (2**self.depth - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x), -40, 40)))


def cut_points(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """At most ``bins - 1`` cut points per column, between values that differ."""
    cuts = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
        cuts.append((values[1:] + values[:-1]) / 2)
    return cuts


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 80,
    depth: int = 4,
    rate: float = 0.12,
    bins: int = 64,
    ridge: float = 5.0,
    least: float = 4.0,
) -> Trees:
    """Boosted trees for labels 0 and 1; without both labels, a constant score.

    ``least`` is the smallest sum of second derivatives on either side of a split.
    """
    leaves, inner = 2**depth, 2**depth - 1
    feature = np.zeros((rounds, inner), np.int64)
    threshold = np.full((rounds, inner), np.inf)
    value = np.zeros((rounds, leaves))
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    start = float(np.log(share / (1 - share)))
    model = Trees(start, depth, feature, threshold, value)
    if not len(y) or y.min() == y.max():
        return model
    cuts = cut_points(x, bins)
    codes = [np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)]
    raw = np.full(len(y), start)
    for t in range(rounds):
        p = 1.0 / (1.0 + np.exp(-raw))
        slope, curve = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            g_all = np.bincount(local, slope, width)
            h_all = np.bincount(local, curve, width)
            best = np.full(width, 1e-6)
            for f, code in enumerate(codes):
                n = len(cuts[f]) + 1
                if n == 1:
                    continue
                place = local * n + code
                g = np.cumsum(np.bincount(place, slope, width * n).reshape(width, n), 1)[:, :-1]
                h = np.cumsum(np.bincount(place, curve, width * n).reshape(width, n), 1)[:, :-1]
                g_right, h_right = g_all[:, None] - g, h_all[:, None] - h
                gain = (
                    g**2 / (h + ridge)
                    + g_right**2 / (h_right + ridge)
                    - (g_all**2 / (h_all + ridge))[:, None]
                )
                gain[(h < least) | (h_right < least)] = -1.0
                cut = gain.argmax(1)
                top = gain[np.arange(width), cut]
                better = top > best
                best[better] = top[better]
                feature[t, first : first + width][better] = f
                threshold[t, first : first + width][better] = cuts[f][cut[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        step = np.bincount(leaf, slope, leaves) / (np.bincount(leaf, curve, leaves) + ridge)
        value[t] = rate * step
        raw += value[t, leaf]
    return model
