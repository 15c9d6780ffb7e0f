"""Frequent-pattern trees of term rows: sums over pairs of groups.

A row is a path: the groups in which a term occurs, in the order of their numbers,
each with its count. Rows that begin alike share nodes, and a node holds how many
terms pass through it. A pair of groups meets in a term exactly once as a node and
one of its ancestors, so what the pair's counts add is worked out once for the node
and ancestor, times the node's terms. All numbers are integers of 64 bits.
"""

from __future__ import annotations

import numpy as np

#: Node and ancestor combinations that are worked out at a time.
STEP = 1 << 20


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q)) of integers from 1 to 1,000,000,001."""
    return (p - q) ** 2 // (p + q)


class Tree:
    """Nodes of all paths: group, count, parent (-1: none), terms; parents come first."""

    def __init__(self, groups: np.ndarray, counts: np.ndarray, offsets: np.ndarray, terms: np.ndarray):
        """Paths as flat arrays with row offsets, and how many terms have each path."""
        length = np.diff(offsets)
        at = np.full(len(length), -1, np.int64)  # each row's node, as deep as it has come
        parts: list[tuple[np.ndarray, ...]] = []
        size = 0
        for depth in range(int(length.max(initial=0))):
            row = np.flatnonzero(length > depth)
            key = np.stack([at[row], groups[offsets[row] + depth], counts[offsets[row] + depth]])
            nodes, which = np.unique(key, axis=1, return_inverse=True)
            weight = np.zeros(nodes.shape[1], np.int64)
            np.add.at(weight, which.ravel(), terms[row])
            at[row] = size + which.ravel()
            parts.append((*nodes, weight))
            size += nodes.shape[1]
        joined = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4
        self.parent, self.group, self.count, self.terms = joined

    def pair_sums(self, weight: np.ndarray, none: np.ndarray) -> np.ndarray:
        """For groups a < b, the sum over the tree's terms of what their counts change.

        ``weight`` is the share of each node's count in its group, ``none`` the share
        of a missing term in each group; a term that neither group has adds nothing.
        """
        n = len(none)
        sums = np.zeros((n, n), np.int64)
        base = divergence(none[:, None], none[None, :])
        # terms of one group with the share of a missing term in every other
        shares, which = np.unique(np.stack([self.group, weight]), axis=1, return_inverse=True)
        times = np.zeros(shares.shape[1], np.int64)
        np.add.at(times, which.ravel(), self.terms)
        for low in range(0, len(times), max(1, STEP // max(n, 1))):
            part = slice(low, low + max(1, STEP // max(n, 1)))
            group, share = shares[0, part], shares[1, part]
            change = (divergence(share[:, None], none[None, :]) - base[group]) * times[part, None]
            np.add.at(sums, group, change)
        sums += sums.T.copy()
        np.fill_diagonal(sums, 0)
        # nodes with their ancestors: both groups have the term
        for low in range(0, len(self.parent), STEP):
            node = np.arange(low, min(low + STEP, len(self.parent)))
            above = self.parent[node]
            while len(node := node[above >= 0]):
                above = above[above >= 0]
                a, b, p, q = self.group[above], self.group[node], weight[above], weight[node]
                change = divergence(p, q) - divergence(p, none[b]) - divergence(none[a], q) + base[a, b]
                np.add.at(sums, (a, b), change * self.terms[node])
                above = self.parent[above]
        return np.triu(sums, 1)
