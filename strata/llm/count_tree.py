"""R-trees of count vectors.

The members of a set are hashed into groups; the number in each group is a point. The overlap of two sets is
at most the sum of the smaller counts of each group, and that of any sets in two boxes at most the sum of
the smaller upper bounds: a pair of boxes that cannot hold a linked pair is left out with all below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 16
FAN = 8
CHUNK = 1 << 14


def count_vectors(members: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """Members of each set per group, the groups given by the first ``bits`` bits: (sets, 2 ** bits)."""
    sets = len(bounds) - 1
    group = (members.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    owner = np.repeat(np.arange(sets), np.diff(bounds))
    return np.bincount((owner << bits) | group, minlength=sets << bits).reshape(sets, 1 << bits).astype(np.int32)


def may_link(overlap: np.ndarray, size: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes (or larger ones) with this overlap at most reach the similarity."""
    return (100 + percent) * overlap.astype(np.int64) >= percent * (size + other)


class CountTree:
    """Points with their set sizes, packed by splitting at the median of the widest coordinate. Each level has for its
    nodes the upper bounds, the smallest and the largest size, and the first child (level 0: point)."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order, cuts = self._packed(points)
        self.points, self.sizes = points[self.order], sizes[self.order]
        first = np.array([0, *cuts], np.int64)
        self.levels = [self._level(self.points, self.sizes, self.sizes, first)]
        while len(self.levels[-1][0]) > FAN:
            high, low_size, high_size, _ = self.levels[-1]
            self.levels.append(self._level(high, low_size, high_size, np.arange(0, len(high), FAN)))

    @staticmethod
    def _packed(points: np.ndarray) -> tuple[np.ndarray, list[int]]:
        order, cuts = np.arange(len(points)), []
        waiting = [(0, len(points))]
        while waiting:
            begin, end = waiting.pop()
            if end - begin <= LEAF:
                cuts.append(begin)
                continue
            own = points[order[begin:end]]
            widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            middle = (end - begin) // 2
            order[begin:end] = order[begin:end][np.argpartition(own[:, widest], middle)]
            waiting += [(begin, begin + middle), (begin + middle, end)]
        return order, sorted(cuts)[1:]

    @staticmethod
    def _level(high: np.ndarray, low_size: np.ndarray, high_size: np.ndarray, first: np.ndarray) -> tuple:
        return (
            np.maximum.reduceat(high, first, axis=0), np.minimum.reduceat(low_size, first),
            np.maximum.reduceat(high_size, first), np.append(first, len(high)),
        )

    def classes(self, labels: np.ndarray) -> list[np.ndarray]:
        """For each level the label that all points of a node share, or -1."""
        low = high = labels[self.order]
        found = []
        for *_, first in self.levels:
            low, high = np.minimum.reduceat(low, first[:-1]), np.maximum.reduceat(high, first[:-1])
            found.append(np.where(low == high, low, -1))
        return found

    def join(
        self, other: CountTree, percent: int, labels: np.ndarray | None = None, others: np.ndarray | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points whose bound reaches the similarity, as places in both inputs. With labels (0 and
        above) pairs of equal labels are left out."""
        labels = np.full(len(self.sizes), -2) if labels is None else labels
        others = np.full(len(other.sizes), -3) if others is None else others
        mine, theirs = self.classes(labels), other.classes(others)
        stack = [(len(self.levels) - 1, len(other.levels) - 1, *_product(len(self.levels[-1][0]), len(other.levels[-1][0])))]
        while stack:
            level, level_other, a, b = stack.pop()
            if len(a) > CHUNK:
                stack += [(level, level_other, a[:CHUNK], b[:CHUNK]), (level, level_other, a[CHUNK:], b[CHUNK:])]
                continue
            if level < 0 and level_other < 0:
                apart = labels[self.order[a]] != others[other.order[b]]
                a, b = a[apart], b[apart]
                overlap = np.minimum(self.points[a], other.points[b]).sum(axis=1)
                kept = may_link(overlap, self.sizes[a], other.sizes[b], percent)
                if kept.any():
                    yield self.order[a[kept]], other.order[b[kept]]
                continue
            high, low_size, high_size, uniform = self._nodes(level, mine)
            high_b, low_size_b, high_size_b, uniform_b = other._nodes(level_other, theirs)
            kept = 100 * high_size[a] >= percent * low_size_b[b]
            kept &= 100 * high_size_b[b] >= percent * low_size[a]
            kept &= (uniform[a] != uniform_b[b]) | (uniform[a] < 0)
            a, b = a[kept], b[kept]
            overlap = np.minimum(high[a], high_b[b]).sum(axis=1)
            kept = may_link(overlap, low_size[a], low_size_b[b], percent)
            a, b = a[kept], b[kept]
            # The higher of the two nodes is opened, or both.
            deeper, deeper_b = level - (level >= level_other), level_other - (level_other >= level)
            if deeper < level:
                a, b = _children(a, b, self.levels[level][3])
            if deeper_b < level_other:
                b, a = _children(b, a, other.levels[level_other][3])
            if len(a):
                stack.append((deeper, deeper_b, a, b))

    def _nodes(self, level: int, uniform: list[np.ndarray]) -> tuple:
        if level < 0:
            return self.points, self.sizes, self.sizes, np.full(len(self.sizes), -1)
        return *self.levels[level][:3], uniform[level]


def _product(rows: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(rows), columns), np.tile(np.arange(columns), rows)


def _children(a: np.ndarray, b: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once for each child of the first of its nodes."""
    counts = first[a + 1] - first[a]
    before = np.cumsum(counts) - counts
    child = np.arange(int(counts.sum())) - np.repeat(before, counts) + np.repeat(first[a], counts)
    return child, np.repeat(b, counts)


class Links:
    """Classes of points that links connect."""

    def __init__(self, points: int):
        self.root = list(range(points))

    def top(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """Connect two points; whether they were apart."""
        x, y = self.top(i), self.top(j)
        self.root[max(x, y)] = min(x, y)
        return x != y

    def labels(self) -> np.ndarray:
        return np.array([self.top(i) for i in range(len(self.root))], np.int64)
