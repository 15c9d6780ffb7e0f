"""Best-fit decreasing and lower bounds from dual feasible functions, on integers.

A function f from [0, 1] to itself is dual feasible if the f of sizes that fit one
bin together never sum over 1. So the sum of f over all sizes bounds the number of
bins from below. The bounds are exact fractions of integers.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from fractions import Fraction

import numpy as np

#: Parameters k of the rounding functions that are tried.
ROUNDINGS = 20


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Fraction:
    """The largest of the functions' sums, in bins; round it up for a number of bins.

    Three families: sizes rounded to multiples of 1 / (k + 1); sizes over 1 - e
    counted whole and those under e not at all; large sizes counted by what they
    leave for pieces of e.
    """
    if not len(lengths):
        return Fraction(0)
    order = np.argsort(lengths)
    x, n = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    best = Fraction(int((x * n).sum()), capacity)
    for k in range(1, ROUNDINGS + 1):
        up, rest = np.divmod((k + 1) * x, capacity)
        best = max(best, Fraction(int((np.where(rest == 0, k * x, up * capacity) * n).sum()), k * capacity))
    small = np.unique(np.r_[x[2 * x <= capacity], capacity - x[2 * x > capacity]])
    small = small[small > 0]
    if len(small):
        upto, weight = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(x * n)])
        low, high = np.searchsorted(x, small), np.searchsorted(x, capacity - small, side="right")
        best = max(best, Fraction(int((weight[high] - weight[low] + capacity * (upto[-1] - upto[high])).max()), capacity))
        for e in small:
            g = capacity // int(e)
            value = np.where(2 * x > capacity, 2 * (g - (capacity - x) // e), np.where(2 * x == capacity, g, np.where(x >= e, 2, 0)))
            best = max(best, Fraction(int((value * n).sum()), 2 * g))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset in the bin) of each item, and the number of bins.

    Longest first (equal ones in the given order), each into the fullest bin that
    it fits.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: dict[int, list[int]] = {}
    rooms: list[int] = []
    n_bins = 0
    for item in np.argsort(-np.asarray(lengths, np.int64), kind="stable").tolist():
        length = int(lengths[item])
        at = bisect_left(rooms, length)
        if at == len(rooms):
            left, bin_ = capacity, n_bins
            n_bins += 1
        else:
            left = rooms[at]
            bin_ = room[left].pop()
            if not room[left]:
                del rooms[at]
        bins[item], offsets[item] = bin_, capacity - left
        left -= length
        if left:
            if not room.get(left):
                insort(rooms, left)
            room.setdefault(left, []).append(bin_)
    return bins, offsets, n_bins
