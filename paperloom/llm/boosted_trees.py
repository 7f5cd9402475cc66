"""Gradient-boosted trees for a yes/no label: histogram training and scoring over flat numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All trees' nodes one after another. A leaf has feature -1; scores are log odds."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[node], self.left[node], self.right[node])
                node = np.where(inner, down, node)
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[int, int], trees: int = 60, depth: int = 4, bins: int = 32, rate: float = 0.2, least: int = 20, l2: float = 1.0) -> Forest:
    """Newton boosting. ``monotone`` maps a feature to +1 or -1: the score may only rise or only fall with it.

    Splits that break a constraint are refused, and the children of a constrained split keep to either side of the
    middle of their values, so the whole tree obeys it. Without both labels the forest has no tree and scores the base rate.
    """
    n, width = x.shape
    rate_yes = (y.sum() + 1) / (n + 2)
    nodes: list[list] = []
    roots: list[int] = []
    score = np.full(n, np.log(rate_yes / (1 - rate_yes)))
    base = float(np.log(rate_yes / (1 - rate_yes)))
    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)], 1)  # bin b: cut[b-1] < x <= cut[b]
        code = binned + np.arange(width) * bins
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)

            def grow(rows: np.ndarray, level: int, low: float, high: float, g=g, h=h) -> int:
                total_g, total_h = g[rows].sum(), h[rows].sum()
                own = float(np.clip(total_g / (total_h + l2), low, high))
                at = len(nodes)
                nodes.append([-1, 0.0, at, at, rate * own])
                if level == depth or len(rows) < 2 * least:
                    score[rows] += rate * own
                    return at
                flat = code[rows].ravel()
                size = width * bins
                sums = [np.bincount(flat, np.repeat(v[rows], width) if v is not None else None, size).reshape(width, bins).cumsum(1) for v in (g, h, None)]
                gl, hl, nl = sums
                gr, hr, nr = total_g - gl, total_h - hl, len(rows) - nl
                vl, vr = gl / (hl + l2), gr / (hr + l2)
                gain = gl * vl + gr * vr - total_g**2 / (total_h + l2)
                gain[(nl < least) | (nr < least)] = -1
                for j, way in monotone.items():
                    gain[j][way * (vr[j] - vl[j]) < 0] = -1
                j, b = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[j, b] <= 1e-6 or b >= len(cuts[j]):
                    score[rows] += rate * own
                    return at
                side = binned[rows, j] <= b
                way, middle = monotone.get(int(j), 0), (np.clip(vl[j, b], low, high) + np.clip(vr[j, b], low, high)) / 2
                bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[way]
                left = grow(rows[side], level + 1, *bounds[0])
                right = grow(rows[~side], level + 1, *bounds[1])
                nodes[at] = [int(j), float(cuts[j][b]), left, right, 0.0]
                return at

            roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
    table = list(zip(*nodes, strict=True)) if nodes else [[]] * 5
    kinds = (np.int64, float, np.int64, np.int64, float)
    return Forest(*(np.array(c, k) for c, k in zip(table, kinds, strict=True)), np.array(roots, np.int64), base, depth)
