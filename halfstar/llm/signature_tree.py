"""Signature trees: which sets of a block are similar, found by traversing two trees together.

A node holds the OR of the token bitmaps below it and the range of their set sizes. Two
nodes can be passed over when no two sets below them can share enough tokens: the common
bits, with what collisions may hide, bound the overlap from above, and the
sizes bound the overlap that is needed from below.
"""

from __future__ import annotations

import numpy as np

#: Children of a node.
FAN = 8
#: Bits for each token of the largest set, and the largest bitmap.
BITS_PER_TOKEN, MAX_BITS = 4, 1 << 16


class Forest:
    """Union-find over local indexes; the smallest index is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


class Tree:
    """Levels of nodes over sets in an order that keeps similar sets together; level 0 are the sets."""

    def __init__(self, sets: list[np.ndarray], ids: np.ndarray, bits: int):
        # neighbours in this order: near in size, then by the smallest token, which similar sets tend to share
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]).bit_length(), int(sets[i][0])))
        self.sets = [sets[i] for i in order]
        self.ids = ids[order]
        words = bits // 64
        maps = np.zeros((len(sets), words), dtype=np.uint64)
        for row, tokens in zip(maps, self.sets, strict=True):
            where = tokens & np.uint64(bits - 1)
            np.bitwise_or.at(row, (where >> np.uint64(6)).astype(np.int64), np.uint64(1) << (where & np.uint64(63)))
        sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        hidden = sizes - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, hidden)]
        while len(maps) > 1:
            cuts = np.arange(0, len(maps), FAN)
            low, high, most = self.levels[-1][1:]
            maps = np.bitwise_or.reduceat(maps, cuts, axis=0)
            self.levels.append((maps, np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts), np.maximum.reduceat(most, cuts)))


def bitmap_bits(largest: int) -> int:
    return min(MAX_BITS, max(256, 1 << (BITS_PER_TOKEN * largest - 1).bit_length()))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exactly: 100 * |a and b| >= percent * |a or b|, for sorted distinct tokens."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int(np.count_nonzero(b[at] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


def link_sets(left: Tree, right: Tree, percent: int, forest: Forest) -> None:
    """Traverse two trees (or one with itself) and link what is similar; what is linked already is not compared."""
    same = left is right
    lefts, rights = np.array([0]), np.array([0])
    height = max(len(left.levels), len(right.levels)) - 1
    for level in range(height, -1, -1):
        a, b = (tree.levels[min(level, len(tree.levels) - 1)] for tree in (left, right))
        keep = _may_match(a, b, lefts, rights, percent)
        lefts, rights = lefts[keep], rights[keep]
        if level and len(lefts):
            lefts, rights = _children(left, right, level, lefts, rights)
            if same:
                lower = lefts <= rights
                lefts, rights = lefts[lower], rights[lower]
    for i, j in zip(lefts.tolist(), rights.tolist(), strict=True):
        if same and i == j:
            continue
        x, y = int(left.ids[i]), int(right.ids[j])
        if forest.root(x) != forest.root(y) and similar(left.sets[i], right.sets[j], percent):
            forest.link(x, y)


def _children(left: Tree, right: Tree, level: int, lefts: np.ndarray, rights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    def below(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, int]:
        if level > len(tree.levels) - 1:  # the other tree is higher: stay at this one's root
            return nodes[:, None], 1
        return nodes[:, None] * FAN + np.arange(FAN), len(tree.levels[level - 1][0])

    (a, na), (b, nb) = below(left, lefts), below(right, rights)
    pairs_a = np.repeat(a, b.shape[1], axis=1).ravel()
    pairs_b = np.tile(b, (1, a.shape[1])).ravel()
    there = (pairs_a < na) & (pairs_b < nb)
    return pairs_a[there], pairs_b[there]


def _may_match(a: tuple, b: tuple, lefts: np.ndarray, rights: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets below two nodes can be similar, by size ranges first, then by bitmaps."""
    (maps_a, low_a, high_a, most_a), (maps_b, low_b, high_b, most_b) = a, b
    keep = (100 * high_a[lefts] >= percent * low_b[rights]) & (100 * high_b[rights] >= percent * low_a[lefts])
    for part in np.array_split(np.flatnonzero(keep), max(1, int(keep.sum()) * maps_a.shape[1] >> 20)):
        x, y = lefts[part], rights[part]
        shared = np.bitwise_count(maps_a[x] & maps_b[y]).sum(axis=1, dtype=np.int64) + np.minimum(most_a[x], most_b[y])
        shared = np.minimum(shared, np.minimum(high_a[x], high_b[y]))
        keep[part] = (100 + percent) * shared >= percent * (low_a[x] + low_b[y])
    return keep
