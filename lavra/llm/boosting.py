"""Gradient-boosted trees for two classes, in numpy: logistic loss, quantile bins, small trees."""

from __future__ import annotations

import numpy as np


class Boosted:
    """``trees``: lists of nodes ``[feature, threshold, left, right]`` or ``[-1, value]``; a value goes left up to the threshold."""

    def __init__(self, base: float, trees: list[list[list[float]]]):
        self.base, self.trees = base, trees
        self._arrays: tuple | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the rows of ``x``: all rows go down all trees together, level by level."""
        if self._arrays is None:
            most = max(len(t) for t in self.trees)
            pad = np.zeros((len(self.trees), most, 4))
            pad[:, :, 0] = -1
            for i, t in enumerate(self.trees):
                for j, n in enumerate(t):
                    pad[i, j, : len(n)] = n
            leaf = pad[:, :, 0] < 0
            into = np.where(leaf[:, :, None], np.arange(most)[None, :, None], pad[:, :, 2:]).astype(np.int32)
            self._arrays = np.where(leaf, 0, pad[:, :, 0]).astype(np.int32), np.where(leaf, np.inf, pad[:, :, 1]), into[:, :, 0], into[:, :, 1], np.where(leaf, pad[:, :, 1], 0.0), leaf
        feature, threshold, left, right, value, leaf = self._arrays
        trees, out = np.arange(len(self.trees))[None, :], np.empty(len(x))
        for a in range(0, len(x), 8192):
            part = x[a : a + 8192]
            rows, at = np.arange(len(part))[:, None], np.zeros((len(part), len(self.trees)), np.int32)
            while not leaf[trees, at].all():
                at = np.where(part[rows, feature[trees, at]] <= threshold[trees, at], left[trees, at], right[trees, at])
            out[a : a + 8192] = value[trees, at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(out + self.base, -30, 30)))

    def most(self, known: dict[int, float]) -> float:
        """No row with these values of these features has a higher sum of leaves, whatever its other features; above 0 is 0.5 and more."""

        def highest(tree: list[list[float]], at: int) -> float:
            feature, value, *into = tree[at]
            if feature < 0:
                return value
            if feature in known:
                return highest(tree, int(into[known[feature] > value]))
            return max(highest(tree, int(i)) for i in into)

        return self.base + sum(highest(t, 0) for t in self.trees)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, least: int = 8, ridge: float = 1.0) -> Boosted:
        mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        base = float(np.log(mean / (1 - mean)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        score, made = np.full(len(y), base), []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
            nodes: list[list[float]] = []

            def grow(rows: np.ndarray, level: int) -> int:
                at = len(nodes)
                g, h = grad[rows].sum(), hess[rows].sum()
                nodes.append([-1, float(-rate * g / (h + ridge))])
                if level == depth or len(rows) < 2 * least:
                    return at
                best = (1e-6, -1, -1)
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gs = np.bincount(binned[rows, j], weights=grad[rows], minlength=len(c) + 1).cumsum()[:-1]
                    hs = np.bincount(binned[rows, j], weights=hess[rows], minlength=len(c) + 1).cumsum()[:-1]
                    ns = np.bincount(binned[rows, j], minlength=len(c) + 1).cumsum()[:-1]
                    gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
                    gain[(ns < least) | (len(rows) - ns < least)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, k)
                if best[1] < 0:
                    return at
                _, j, k = best
                left = binned[rows, j] <= k
                a = grow(rows[left], level + 1)
                b = grow(rows[~left], level + 1)
                nodes[at] = [j, float(cuts[j][k]), a, b]
                return at

            grow(np.arange(len(y)), 0)
            made.append(nodes)
            p = np.clip(cls(0.0, [nodes]).score(x), 1e-9, 1 - 1e-9)
            score = score + np.log(p / (1 - p))
        return cls(base, made)

    def to_json(self) -> dict:
        return {"base": round(self.base, 6), "trees": [[[round(float(v), 5) for v in n] for n in t] for t in self.trees]}

    @classmethod
    def from_json(cls, data: dict) -> Boosted:
        return cls(data["base"], data["trees"])
