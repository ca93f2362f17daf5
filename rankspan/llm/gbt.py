"""Histogram gradient-boosted trees for two classes.

Training works on a bounded matrix on the driver; every feature is cut into at
most ``bins`` quantile bins, a level of a tree is grown from gradient
histograms.  Trees are complete and kept in heap order, so a model is four flat
arrays and applying it is ``depth`` numpy steps for all rows and trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    feature: np.ndarray     # (trees, 2**depth - 1) feature of each inner node
    threshold: np.ndarray   # same shape; a row goes right where its value is larger
    value: np.ndarray       # (trees, 2**depth) leaf values
    bias: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values for each row of ``x``."""
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - (2**self.depth - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -500, 500)))


def _quantiles(x: np.ndarray, times: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """The lower quantiles of values that stand for ``times`` equal ones each."""
    order = np.argsort(x, kind="stable")
    upto = np.cumsum(times[order])
    return x[order][np.searchsorted(upto, np.floor((upto[-1] - 1) * shares), side="right")]


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        l2: float = 1.0, least_rows: int = 8, weight: np.ndarray | None = None, times: np.ndarray | None = None) -> Trees:
    """Boost ``trees`` trees on log loss; ``weight``: of each row (1 on the mean);
    ``times``: how many equal rows each one stands for (the model is that of all).
    One class only, or no rows, gives a model without splits."""
    n, width = x.shape
    y = y.astype(float)
    times = np.ones(n) if times is None else times
    weight = times if weight is None else weight * times
    share = ((weight * y).sum() + 0.5) / (weight.sum() + 1.0)
    bias = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    model = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), bias, depth)
    if n == 0 or y.min() == y.max():
        return model
    edges = [np.unique(_quantiles(x[:, f], times, np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    margin = np.full(n, bias)
    features, thresholds, values = [], [], []
    offset = np.arange(width) * bins
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        grad, hess = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * (width * bins) + offset + code).ravel()
            size = count * width * bins
            shape = (count, width, bins)
            g, h, c = (np.cumsum(np.bincount(slot, np.repeat(v, width), size).reshape(shape), axis=2)
                       for v in (grad, hess, times))
            gt, ht, ct = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g**2 / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt**2 / (ht + l2)
            gain[(c < least_rows) | (ct - c < least_rows)] = -1.0
            best = gain.reshape(count, -1).argmax(axis=1)
            for i in range(count):
                f, b = divmod(int(best[i]), bins)
                if gain[i, f, b] > 1e-6 and b < len(edges[f]):
                    feature[first + i], threshold[first + i] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + l2)
        margin += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), bias, depth)
