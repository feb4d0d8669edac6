"""A persistent search tree in arrays.

The tree over K sorted keys is balanced and has H = ceil(log2 K) levels above its leaves. Every update makes a new root by
path copying: one new node on each level of the path to its leaf, whose other child is the newest node, at that time,
of the neighbouring block. A node is known by (level, update), so only the other child of each needs storing: H arrays
of one entry per update, built level by level with sorts instead of one insertion at a time. A search starts at the
root of a version and descends with one step per level for a whole batch of questions."""

from __future__ import annotations

import numpy as np


class PersistentTree:
    """``ranks``: for each update, in the order in which they became known, the rank of its key among ``n_keys``."""

    def __init__(self, ranks: np.ndarray, n_keys: int):
        self.ranks = np.asarray(ranks, dtype=np.int64)
        self.height = max(0, int(n_keys - 1).bit_length())
        t = np.arange(len(self.ranks), dtype=np.int64)
        n = max(1, len(t))
        self.other: list[np.ndarray] = []
        for level in range(self.height):
            block = self.ranks >> (self.height - level - 1)  # of the child on the path
            made = np.sort(block * n + t)
            at = np.searchsorted(made, (block ^ 1) * n + t) - 1
            found = made[np.maximum(at, 0)]
            self.other.append(np.where((at >= 0) & (found // n == block ^ 1), found % n, -1))

    def search(self, roots: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """For each question, the update that holds the key ``ranks`` in the version of root ``roots`` (-1: the empty
        tree), or -1."""
        node, want = np.array(roots, dtype=np.int64), np.asarray(ranks, dtype=np.int64)
        node[want < 0] = -1
        for level in range(self.height):
            live = np.flatnonzero(node >= 0)
            if not len(live):
                break
            shift = self.height - level - 1
            off = (self.ranks[node[live]] >> shift) != (want[live] >> shift)
            node[live[off]] = self.other[level][node[live[off]]]
        live = np.flatnonzero(node >= 0)
        node[live[self.ranks[node[live]] != want[live]]] = -1
        return node
