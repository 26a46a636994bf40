"""Spanning forests of the links that one task has found."""

from __future__ import annotations

import numpy as np


class Forest:
    """Links kept as a spanning forest of least distances: never more than the members."""

    def __init__(self) -> None:
        self.a, self.b, self.d, self.held = [], [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> None:
        if len(a):
            self.a.append(a), self.b.append(b), self.d.append(d)
            self.held += len(a)
            if self.held > 500_000:
                self._shrink()

    def _shrink(self) -> None:
        a, b, d = map(np.concatenate, (self.a, self.b, self.d))
        nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = ends[: len(a)], ends[len(a) :]
        root, keep = np.arange(len(nodes)), np.zeros(len(a), bool)
        order = np.lexsort((y, x, d))
        # each tree takes its first link to another tree, then trees merge, until none is left
        while True:
            rx, ry = root[x[order]], root[y[order]]
            order = order[rx != ry]
            if not len(order):
                break
            rx, ry = root[x[order]], root[y[order]]
            first = np.full(len(nodes), len(order))
            at = np.arange(len(order))
            np.minimum.at(first, rx, at)
            np.minimum.at(first, ry, at)
            chosen = np.unique(first[first < len(order)])
            keep[order[chosen]] = True
            cx, cy = rx[chosen], ry[chosen]
            while True:
                was = root.copy()
                low = np.minimum(root[cx], root[cy])
                np.minimum.at(root, root[cx], low)
                np.minimum.at(root, root[cy], low)
                root = root[root]
                if (root == was).all():
                    break
            while (root != root[root]).any():
                root = root[root]
        self.a, self.b, self.d = [a[keep]], [b[keep]], [d[keep]]
        self.held = int(keep.sum())

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.a:
            none = np.empty(0, np.int64)
            return none, none, none
        self._shrink()
        return self.a[0], self.b[0], self.d[0]
