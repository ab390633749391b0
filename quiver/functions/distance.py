"""Mean absolute (mean-L1) distance between two equal-length double arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def mean_l1(a: Column | str, b: Column | str) -> Column:
    """sum(|a_i - b_i|) / n, summed left to right (matches a sequential SQL list sum)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    total = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)
    return total / F.size(b)


def mean_l1_to_rows(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distances of vector ``x`` to each row of ``rows`` (c x d), summed left to right.

    ``cumsum`` accumulates strictly in index order, so threshold tests agree bit
    for bit with :func:`mean_l1` and with a sequential SQL list sum.
    """
    return np.cumsum(np.abs(rows - x), axis=1)[:, -1] / rows.shape[1]


def mean_l1_matrix(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(m x c) distances between ``rows`` (m x d) and ``centres`` (c x d), same summation order."""
    total = np.zeros((len(rows), len(centres)))
    for k in range(centres.shape[1]):  # left to right, as a sequential sum
        total += np.abs(rows[:, k, None] - centres[None, :, k])
    return total / centres.shape[1]


class CentreIndex:
    """A set of centres that leaves out distances which cannot matter.

    Two lower bounds of mean-L1 come from the triangle inequality: sums over
    ``GROUP`` neighbouring positions differ by no more than the positions do, and the
    distances of two vectors to a pivot differ by no more than the vectors.  Pivots are
    centres far from one another.  Where a probe of the rows shows that the bounds leave out
    too little, every distance is computed.
    """

    GROUP = 4
    PROBE = 64  # rows of a batch on which the bounds are tried
    PAYS = 0.3  # share of the pairs up to which survivors are gathered one by one

    def __init__(self, mat: np.ndarray, pivots: int = 4) -> None:
        self.mat = mat
        self.by_position = np.ascontiguousarray(mat.T)
        self.sums = self._sums(mat)
        finite = np.flatnonzero(np.isfinite(mat).all(axis=1)) if pivots else np.empty(0, np.int64)
        self.pivots = mat[self._apart(finite, pivots)] if len(finite) else mat[:0]
        self.to_pivots = mean_l1_matrix(mat, self.pivots)
        self.scale = np.abs(mat).max(initial=0.0)

    def _sums(self, rows: np.ndarray) -> np.ndarray:
        return np.add.reduceat(rows, np.arange(0, rows.shape[1], self.GROUP), axis=1)

    def _apart(self, among: np.ndarray, n: int) -> list[int]:
        """Up to ``n`` centres, each the farthest from those before it."""
        chosen = [int(among[0])]
        away = mean_l1_to_rows(self.mat[chosen[0]], self.mat[among])
        while len(chosen) < n and away.max() > 0:
            chosen.append(int(among[away.argmax()]))
            away = np.minimum(away, mean_l1_to_rows(self.mat[chosen[-1]], self.mat[among]))
        return chosen

    def distances(self, rows: np.ndarray, within: float, nearest: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(rows x centres) distances, infinite where one is neither below ``within`` nor the least, and how many were computed per row.

        ``nearest``: per row the least distance known so far; None where the least is not asked for.
        Distances that are not numbers are never left out.
        """
        m, c = len(rows), len(self.mat)
        plain = lambda: (mean_l1_matrix(rows, self.mat), np.full(m, c, dtype=np.int64))
        if rows.shape[1] <= self.GROUP or not m * c or len(self.pivots) >= c:
            return plain()
        some = np.arange(0, m, max(1, m // self.PROBE))
        if self._open(rows[some], within, None if nearest is None else nearest[some])[0].mean() > self.PAYS:
            return plain()
        may, limit = self._open(rows, within, nearest)
        i, j = np.nonzero(may)
        pivoted = mean_l1_matrix(rows, self.pivots)
        for p in range(len(self.pivots)):
            keep = ~(np.abs(pivoted[i, p] - self.to_pivots[j, p]) > limit[i])
            i, j = i[keep], j[keep]
        out = np.full((m, c), np.inf)
        out[i, j] = self._pairs(rows, i, j)
        return out, np.bincount(i, minlength=m) + len(self.pivots) + (nearest is not None)

    def _pairs(self, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        total = np.zeros(len(i))
        for x, y in zip(np.ascontiguousarray(rows.T), self.by_position):  # left to right, as a sequential sum
            apart = x.take(i)
            apart -= y.take(j)
            total += np.abs(apart, out=apart)
        return total / rows.shape[1]

    def _open(self, rows: np.ndarray, within: float, nearest: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose distance may matter, and the limit per row beyond which none does."""
        sums = self._sums(rows)
        low = np.zeros((len(rows), len(self.mat)))
        for k in range(sums.shape[1]):
            low += np.abs(sums[:, k, None] - self.sums[None, :, k])
        low /= self.mat.shape[1]
        limit = np.full(len(rows), float(within))
        if nearest is not None:  # the centre of the least bound shows how near the nearest one is at most
            first = np.where(np.isnan(low), np.inf, low).argmin(axis=1)
            limit = np.maximum(limit, np.fmin(nearest, self._pairs(rows, np.arange(len(rows)), first)))
        # far above the rounding of sums and the grid on which near ties are snapped
        limit = limit + 1e-11 + 1e-13 * rows.shape[1] * (np.abs(rows).max(initial=0.0) + self.scale)
        return ~(low > limit[:, None]), limit
