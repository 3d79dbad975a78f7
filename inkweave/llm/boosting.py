"""Gradient-boosted trees for two classes, in numpy: small, deterministic, for bounded samples only."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Logistic loss, trees of depth ``depth`` over features cut into at most ``BINS`` bins."""

    def __init__(self, rounds: int = 50, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> None:
        self.rounds, self.depth, self.rate, self.ridge = rounds, depth, rate, ridge
        self.trees: list[list[tuple[int, float]]] = []
        self.leaves: list[np.ndarray] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        """Rows of one class only give a constant answer; no rows at all answer 0.5."""
        x, y = np.asarray(x, float), np.asarray(y, float)
        if not len(y) or y.min() == y.max():
            self.base = 0.0 if not len(y) else (8.0 if y[0] else -8.0)
            return self
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
        binned = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            node, tree = np.zeros(len(y), int), []
            for level in range(self.depth):
                for n in range(2**level):
                    at = np.flatnonzero(node == n + 2**level - 1)
                    tree.append(self._split(binned, cuts, grad, hess, at))
                for n in range(2**level):
                    me = n + 2**level - 1
                    at = np.flatnonzero(node == me)
                    f, cut = tree[me]
                    node[at] = 2 * me + 1 + (x[at, f] > cut)
            leaf = node - (2**self.depth - 1)
            size = 2**self.depth
            value = self.rate * np.bincount(leaf, grad, size) / (np.bincount(leaf, hess, size) + self.ridge)
            self.trees.append(tree)
            self.leaves.append(value)
            score = score + value[leaf]
        return self

    def _split(self, binned: list, cuts: list, grad: np.ndarray, hess: np.ndarray, at: np.ndarray) -> tuple[int, float]:
        best = (0.0, 0, np.inf)
        g, h = grad[at], hess[at]
        gs, hs = g.sum(), h.sum()
        for f, c in enumerate(cuts):
            if not len(c) or not len(at):
                continue
            b = binned[f][at]
            gl, hl = np.cumsum(np.bincount(b, g, len(c) + 1))[:-1], np.cumsum(np.bincount(b, h, len(c) + 1))[:-1]
            gain = gl**2 / (hl + self.ridge) + (gs - gl) ** 2 / (hs - hl + self.ridge) - gs**2 / (hs + self.ridge)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-12:
                best = (float(gain[k]), f, float(c[k]))
        return best[1], best[2]

    def probability(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        score = np.full(len(x), self.base)
        for tree, value in zip(self.trees, self.leaves):
            node = np.zeros(len(x), int)
            f_of, cut_of = np.array([f for f, _ in tree]), np.array([c for _, c in tree])
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), f_of[node]] > cut_of[node])
            score += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-score))
