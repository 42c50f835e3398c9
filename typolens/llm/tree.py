"""A small decision tree (Gini), fitted on the driver's labelled table and applied to whole arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; leaves have feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            f = self.feature[at]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                return self.value[at]
            a = at[inner]
            low = x[inner, f[inner]] <= self.threshold[a]
            at[inner] = np.where(low, self.left[a], self.right[a])


def _best_split(x: np.ndarray, y: np.ndarray, min_leaf: int) -> tuple[float, int, float] | None:
    n, best = len(y), None
    base = 2 * y.mean() * (1 - y.mean()) * n
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        cut = cut[(cut >= min_leaf) & (n - cut >= min_leaf)]
        if not len(cut):
            continue
        l1 = ones[cut - 1]
        r1 = ones[-1] - l1
        impurity = 2 * (l1 * (cut - l1) / cut + r1 * (n - cut - r1) / (n - cut))
        k = int(np.argmin(impurity))
        gain = base - impurity[k]
        if best is None or gain > best[0] + 1e-12:
            best = (float(gain), f, float(v[cut[k] - 1] + v[cut[k]]) / 2)
    return best


def fit_tree(x: np.ndarray, y: np.ndarray, max_depth: int, min_leaf: int) -> Tree:
    nodes: list[list[float]] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y[rows].mean() > 0.5)])
        split = _best_split(x[rows], y[rows], min_leaf) if depth < max_depth and 0 < y[rows].mean() < 1 else None
        if split and split[0] > 1e-9:
            low = x[rows, split[1]] <= split[2]
            nodes[me][:2] = [split[1], split[2]]
            nodes[me][2] = grow(rows[low], depth + 1)
            nodes[me][3] = grow(rows[~low], depth + 1)
        return me

    grow(np.arange(len(y)), 0)
    a = np.array(nodes)
    return Tree(a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4].astype(int))
