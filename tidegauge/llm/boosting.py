"""Gradient-boosted trees on a bounded sample in memory, for operators that train on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1. Rows with value <= threshold go left."""

    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def add(self) -> int:
        for column, empty in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            column.append(empty)
        return len(self.feature) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        while (inner := feature[at] >= 0).any():
            rows, here = np.flatnonzero(inner), at[inner]
            at[rows] = np.where(x[rows, feature[here]] <= threshold[here], left[here], right[here])
        return np.array(self.value)[at]

    def paths(self) -> list[tuple[tuple[int, bool, float], ...]]:
        """The conditions (feature, whether above, threshold) that lead to each node but the root."""
        out, todo = [], [(0, ())]
        while todo:
            node, path = todo.pop()
            if path:
                out.append(path)
            if self.feature[node] >= 0:
                f, t = self.feature[node], self.threshold[node]
                todo += [(self.left[node], (*path, (f, False, t))), (self.right[node], (*path, (f, True, t)))]
        return out


def edges_of(x: np.ndarray) -> list[np.ndarray]:
    """Candidate thresholds of each feature: between its distinct quantiles."""
    out = []
    for column in x.T:
        cuts = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)))
        out.append((cuts[1:] + cuts[:-1]) / 2)
    return out


def _grow(tree, node, rows, bins, edges, grad, hess, depth, rate, least) -> None:
    g, h = grad[rows].sum(), hess[rows].sum()
    tree.value[node] = -rate * g / (h + 1.0)
    if depth == 0 or len(rows) < 2 * least:
        return
    best = (1e-6, None)
    for f, cuts in enumerate(edges):
        if not len(cuts):
            continue
        b = bins[rows, f]
        n = np.cumsum(np.bincount(b, minlength=len(cuts) + 1))[:-1]
        gl = np.cumsum(np.bincount(b, grad[rows], len(cuts) + 1))[:-1]
        hl = np.cumsum(np.bincount(b, hess[rows], len(cuts) + 1))[:-1]
        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
        gain[(n < least) | (len(rows) - n < least)] = 0
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (gain[k], (f, k))
    if best[1] is None:
        return
    f, k = best[1]
    tree.feature[node], tree.threshold[node] = f, float(edges[f][k])
    goes = bins[rows, f] <= k
    for name, part in (("left", rows[goes]), ("right", rows[~goes])):
        child = tree.add()
        getattr(tree, name)[node] = child
        _grow(tree, child, part, bins, edges, grad, hess, depth - 1, rate, least)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Boosted:
    base: float
    trees: list

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.2, least: int = 5) -> Boosted:
    """Logistic boosting; with one class only, or no rows, a constant."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Boosted(float(np.log(share / (1 - share))), [])
    if len(np.unique(y)) < 2:
        return model
    edges = edges_of(x)
    bins = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(edges)], axis=1)
    margin = np.full(len(y), model.base)
    for _ in range(trees):
        p = sigmoid(margin)
        tree = Tree()
        tree.add()
        _grow(tree, 0, np.arange(len(y)), bins, edges, p - y, p * (1 - p), depth, rate, least)
        margin += tree.predict(x)
        model.trees.append(tree)
    return model
