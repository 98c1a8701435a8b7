"""K-d trees over vectors of small counts, searched for many vectors at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

TOP = 255


class KdTree:
    """Boxes of points; each inner box is cut in two where one dimension parts its points most evenly.

    With ``open`` the boxes of leaves together fill the whole space, so that
    points other than those it was built from have a leaf, too; otherwise a box
    ends at its outermost points.
    """

    def __init__(self, points: np.ndarray, leaf_size: int, open: bool = False):
        dims = points.shape[1]
        self.low, self.high, self.cut, self.leaves = [], [], [], []
        work = [(np.arange(len(points)), np.zeros(dims, np.uint8), np.full(dims, TOP, np.uint8), None)]
        while work:
            at, low, high, slot = work.pop()
            node = len(self.cut)
            if slot is not None:
                self.cut[slot[0]][slot[1]] = node
            inside = points[at]
            if not open and len(at):
                low, high = inside.min(axis=0), inside.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            best = self._best_cut(inside) if len(at) > leaf_size else None
            if best is None:
                self.cut.append([len(self.leaves)])
                self.leaves.append(at)
                continue
            dim, upto = best
            self.cut.append([dim, upto, -1, -1])
            left = inside[:, dim] <= upto
            under, over = high.copy(), low.copy()
            under[dim], over[dim] = upto, upto + 1
            work.append((at[~left], over, high, (node, 3)))
            work.append((at[left], low, under, (node, 2)))

    @staticmethod
    def _best_cut(points: np.ndarray) -> tuple[int, int] | None:
        middle = np.sort(points, axis=0)[(len(points) - 1) // 2]
        best, found = 0, None
        for below in (0, 1):
            upto = middle.astype(np.int16) - below
            left = (points <= upto).sum(axis=0)
            even = np.minimum(left, len(points) - left)
            dim = int(even.argmax())
            if even[dim] > best:
                best, found = int(even[dim]), (dim, int(upto[dim]))
        return found

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf each point belongs to (trees with open boxes)."""
        out = np.zeros(len(points), dtype=np.int64)
        work = [(0, np.arange(len(points)))]
        while work:
            node, at = work.pop()
            cut = self.cut[node]
            if len(cut) == 1:
                out[at] = cut[0]
            else:
                left = points[at, cut[0]] <= cut[1]
                work += [(k, rows) for k, rows in ((cut[2], at[left]), (cut[3], at[~left])) if len(rows)]
        return out

    def reach(self, points: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, and the points from which they are reached by adding up to ``more`` and taking away up to ``less``."""
        work = [(0, np.arange(len(points)))]
        while work:
            node, at = work.pop()
            inside = points[at]
            short = (np.maximum(inside, self.low[node]) - inside).sum(axis=1, dtype=np.uint16)
            beyond = (inside - np.minimum(inside, self.high[node])).sum(axis=1, dtype=np.uint16)
            at = at[(short <= more) & (beyond <= less)]
            if not len(at):
                continue
            cut = self.cut[node]
            if len(cut) == 1:
                yield cut[0], at
            else:
                work += [(cut[2], at), (cut[3], at)]
