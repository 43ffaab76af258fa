"""Gradient-boosted trees for a yes/no label on a bounded sample of feature rows.

Second-order boosting of the logistic loss on binned features (at most ``BINS`` quantile bins).
Trees are complete to a fixed depth, so scoring is a few array look-ups per tree and level.
Deterministic: no sampling; ties go to the first feature and the lowest split.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    base: float
    feature: np.ndarray      # (trees, 2 ** depth - 1)
    split: np.ndarray        # go right if the value is over it
    leaf: np.ndarray         # (trees, 2 ** depth)
    scale: tuple[float, float] = (1.0, 0.0)   # calibration of the log odds

    def odds(self, x: np.ndarray) -> np.ndarray:
        out, depth = np.full(len(x), self.base), int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        rows = np.arange(len(x))
        for f, s, leaf in zip(self.feature, self.split, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > s[node])
            out += leaf[node - (2 ** depth - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.odds(x) + b, -40, 40)))

    def calibrate(self, x: np.ndarray | None, y: np.ndarray, *, odds: np.ndarray | None = None,
                  weight: np.ndarray | None = None) -> None:
        """Slope and offset of the log odds by Newton steps on rows that were not fitted, or on their
        log odds; ``weight`` counts equal rows."""
        z, (a, b) = self.odds(x) if odds is None else odds, (1.0, 0.0)
        n = np.ones(len(y)) if weight is None else weight
        yes, no = n[y > 0].sum(), n[y <= 0].sum()
        goal = np.where(y > 0, (yes + 1) / (yes + 2), 1 / (no + 2))   # softened labels
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
            g = np.array([(n * (p - goal) * z).sum(), (n * (p - goal)).sum()])
            w = n * (p * (1 - p) + 1e-6)
            h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
            d = np.linalg.solve(h, g)
            d *= min(1, 2 / max(1e-9, np.abs(d).max()))
            a, b = a - d[0], b - d[1]
        if np.isfinite([a, b]).all() and a > 0:
            self.scale = (float(a), float(b))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2,
        least: float = 1.0, ridge: float = 1.0, weight: np.ndarray | None = None) -> Trees:
    """Boosted trees for labels ``y`` (0/1); ``weight`` counts equal rows. One class only (or no rows): a constant."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    n = np.ones(len(y)) if weight is None else np.asarray(weight, np.float64)
    share = ((n * y).sum() + 0.5) / (n.sum() + 1)
    base = float(np.log(share / (1 - share)))
    none = np.zeros((0, 2 ** depth - 1))
    if not len(y) or y.min() == y.max():
        return Trees(base, none.astype(np.int64), none, np.zeros((0, 2 ** depth)))
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)], 1)   # <= edge goes left
    n_feat, odds = x.shape[1], np.full(len(y), base)
    cell = bins + np.arange(n_feat) * BINS
    feature, split, leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = n * (p - y), n * p * (1 - p)
        node, f, s = np.zeros(len(y), np.int64), np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            key = ((node - first)[:, None] * n_feat * BINS + cell).ravel()
            sums = [np.bincount(key, np.repeat(v, n_feat), width * n_feat * BINS).reshape(width, n_feat, BINS)
                    for v in (g, h)]
            gl, hl = (np.cumsum(v, 2) for v in sums)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
            gain[(hl < least * 0.1) | (ht - hl < least * 0.1)] = 0
            flat = gain.reshape(width, -1)
            best = flat.argmax(1)
            for k in range(width):
                if flat[k, best[k]] > 1e-9:
                    f[first + k], b = divmod(int(best[k]), BINS)
                    e = edges[f[first + k]]
                    s[first + k] = e[b] if b < len(e) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), f[node]] > s[node])
        end = node - (2 ** depth - 1)
        gs, hs = np.bincount(end, g, 2 ** depth), np.bincount(end, h, 2 ** depth)
        value = -rate * gs / (hs + ridge)
        odds += value[end]
        feature.append(f)
        split.append(s)
        leaf.append(value)
    return Trees(base, np.array(feature), np.array(split), np.array(leaf))


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest threshold whose picks have at least ``precision``; above 1 if there is none."""
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    right = np.cumsum(y) / np.arange(1, len(y) + 1)
    last = np.append(p[1:] != p[:-1], True) if len(p) else np.zeros(0, bool)
    good = np.flatnonzero(last & (right >= precision))
    return float(p[good[-1]]) if len(good) else 1.1
