"""Gradient-boosted trees in flat numpy node arrays, with monotonic constraints."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All nodes of all trees in arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """The log odds of each row; all rows go down all trees together."""
        if not len(self.roots) or not len(rows):
            return np.full(len(rows), self.base)
        node = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        index = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            node = np.where(
                rows[index, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node]
            )
        return self.base + self.value[node].sum(axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(rows)))


def fit(
    rows: np.ndarray,
    good: np.ndarray,
    signs: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    shrink: float = 1.0,
    least: int = 8,
) -> Forest:
    """Boost trees on log loss. ``signs``: 1 for features that may only raise the result, -1 lower, 0 free.

    A split on a signed feature must order its two sides; the mean of the two bounds all that grows
    below either side, so the whole forest is monotonic in the feature. Without rows, or with rows
    of one class, the forest is a constant.
    """
    rate_good = (good.sum() + 0.5) / (len(good) + 1) if len(good) else 0.5
    base = float(np.log(rate_good / (1 - rate_good)))
    if len(good) == 0 or good.min() == good.max():
        none = np.zeros(0)
        return Forest(none.astype(np.int32), none.astype(np.int32), none, none.astype(np.int32), none.astype(np.int32), none, base, 0)
    edges = [np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) for x in rows.T]
    codes = np.stack([np.searchsorted(e, x, side="left") for e, x in zip(edges, rows.T, strict=True)], axis=1)
    margin = np.full(len(rows), base)
    roots: list[int] = []
    nodes: list[list] = []  # feature, threshold, left, right, value
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, curve = good - chance, chance * (1 - chance)
        roots.append(len(nodes))
        nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
        open_nodes = [(len(nodes) - 1, np.arange(len(rows)), -np.inf, np.inf, 0)]
        while open_nodes:
            at, mine, low, high, level = open_nodes.pop()
            g, h = slope[mine].sum(), curve[mine].sum()
            here = float(np.clip(g / (h + shrink), low, high))
            nodes[at][4] = here * rate
            best = (1e-6, -1, 0, 0.0, 0.0)
            if level < depth and len(mine) >= 2 * least:
                for f in range(rows.shape[1]):
                    width = len(edges[f]) + 1
                    if width < 2:
                        continue
                    code = codes[mine, f]
                    gs = np.cumsum(np.bincount(code, slope[mine], width))[:-1]
                    hs = np.cumsum(np.bincount(code, curve[mine], width))[:-1]
                    ns = np.cumsum(np.bincount(code, minlength=width))[:-1]
                    lv = np.clip(gs / (hs + shrink), low, high)
                    rv = np.clip((g - gs) / (h - hs + shrink), low, high)
                    gain = 2 * (gs * lv + (g - gs) * rv) - (hs + shrink) * lv**2 - (h - hs + shrink) * rv**2
                    gain -= 2 * g * here - (h + shrink) * here**2
                    allowed = (ns >= least) & (len(mine) - ns >= least) & (signs[f] * (rv - lv) >= 0)
                    gain = np.where(allowed, gain, -np.inf)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, k, float(lv[k]), float(rv[k]))
            _, f, k, lv, rv = best
            if f < 0:
                margin[mine] += here * rate
                continue
            goes_left = codes[mine, f] <= k
            middle = (lv + rv) / 2
            left, right = len(nodes), len(nodes) + 1
            nodes[at][:4] = [f, float(edges[f][k]), left, right]
            nodes += [[0, 0.0, left, left, 0.0], [0, 0.0, right, right, 0.0]]
            ends = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            (a, b), (c, d) = ends.get(int(signs[f]), ((low, high), (low, high)))
            open_nodes.append((left, mine[goes_left], a, b, level + 1))
            open_nodes.append((right, mine[~goes_left], c, d, level + 1))
    feature, threshold, left, right, value = (np.array(x) for x in zip(*nodes, strict=True))
    return Forest(
        np.array(roots, np.int32), feature.astype(np.int32), threshold.astype(float),
        left.astype(np.int32), right.astype(np.int32), value.astype(float), base, depth,
    )
