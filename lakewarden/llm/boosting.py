"""Gradient-boosted trees with isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from lakewarden.llm.common import sigmoid

BINS = 48
DEPTH = 3


@dataclass
class Trees:
    """Complete trees: ``features[t][i]``, ``cuts[t][i]`` for inner node i, ``leaves[t]`` left to right."""

    base: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, features[node]] > cuts[node])
            out += leaves[node - (2**DEPTH - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.15, penalty: float = 1.0) -> Trees:
    """Logistic loss, splits between quantiles of each feature."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)])
    inner, width = 2**DEPTH - 1, max(len(c) for c in cuts) + 1
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    margin = np.full(len(y), base)
    features = np.zeros((rounds, inner), np.int64)
    limits = np.full((rounds, inner), np.inf)
    leaves = np.zeros((rounds, inner + 1))
    for t in range(rounds):
        chance = sigmoid(margin)
        slope, bend = chance - y, chance * (1 - chance)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-9)
            for f, bins in enumerate(binned):
                key = (node - first) * width + bins
                g = np.bincount(key, slope, count * width).reshape(count, width).cumsum(1)
                h = np.bincount(key, bend, count * width).reshape(count, width).cumsum(1)
                gain = g**2 / (h + penalty) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + penalty) - g[:, -1:] ** 2 / (h[:, -1:] + penalty)
                gain[(h < 0.5) | (h[:, -1:] - h < 0.5)] = 0
                gain = gain[:, : len(cuts[f])]
                if gain.shape[1]:
                    at = gain.argmax(1)
                    for k in np.flatnonzero(gain[np.arange(count), at] > best):
                        best[k] = gain[k, at[k]]
                        features[t, first + k], limits[t, first + k] = f, cuts[f][at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), features[t, node]] > limits[t, node])
        leaf = node - inner
        total, weight = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        leaves[t] = -rate * total / (weight + penalty)
        margin += leaves[t, leaf]
    return Trees(base, features, limits, leaves)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing step function closest to ``y``, by pooling adjacent violators."""
    points, group = np.unique(x, return_inverse=True)
    sums, counts = np.bincount(group, y), np.bincount(group).astype(float)
    pools: list[list[float]] = []
    for at, s, c in zip(points, sums, counts, strict=True):
        pools.append([at, at, s, c])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, high, s2, c2 = pools.pop()
            pools[-1][1:] = [high, pools[-1][2] + s2, pools[-1][3] + c2]
    table = np.array(pools)
    return table[:, :2].reshape(-1), np.repeat(table[:, 2] / table[:, 3], 2)
