"""FM-index over a sequence of integer symbols: wavelet matrix ranks, sampled suffixes.

Symbols are 1 and up; 0 ends a run and never occurs in a pattern. Runs end in
distinct terminators, so suffix order is decided inside a run and the number of
doubling rounds follows the longest run, not the shard.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions in suffix order, by prefix doubling over unresolved suffixes only."""
    n = len(symbols)
    ends = symbols == 0
    n_ends = int(ends.sum())
    rank = symbols.astype(np.int64) + n_ends
    rank[ends] = np.arange(n_ends)
    order = np.argsort(rank, kind="stable")
    step, open_ = 1, None
    # rank: index of the first suffix of its group in the order
    key = rank[order]
    first = np.r_[True, key[1:] != key[:-1]]
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    open_ = np.flatnonzero(~(first & np.r_[first[1:], True]))
    while len(open_):
        at = order[open_]
        head, tail = rank[at], rank[at + step]  # a run's terminator resolves before its end is passed
        by = np.lexsort((tail, head))
        at, head, tail = at[by], head[by], tail[by]
        order[open_] = at
        first = np.r_[True, (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])]
        rank[at] = open_[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        open_ = open_[~(first & np.r_[first[1:], True])]
        step *= 2
    return order


class Bits:
    """Bit vector with rank: packed words and a count before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, bool)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.ones = int(ones.sum())
        self.n = n

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class FMIndex:
    """Backward search and locate; every query is answered for a whole batch of patterns."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        order = suffix_order(symbols)
        last = symbols[order - 1]  # position 0 follows a terminator: the last symbol is 0
        depth = max(1, int(symbols.max(initial=0)).bit_length())
        self.n, self.levels, self.zeros = n, [], []
        for bit in range(depth - 1, -1, -1):
            ones = (last >> bit) & 1 != 0
            self.levels.append((bit, Bits(ones)))
            self.zeros.append(n - int(ones.sum()))
            last = np.r_[last[~ones], last[ones]]
        counts = np.bincount(symbols, minlength=(1 << depth) + 1)
        self.counts, self.before = counts, np.cumsum(counts) - counts
        run_start = np.zeros(n, bool)
        run_start[0] = n > 0
        run_start[1:] = symbols[:-1] == 0
        sampled = (order % SAMPLE_EVERY == 0) | run_start[order]
        self.sampled, self.samples = Bits(sampled), order[sampled]

    def ranks(self, symbol: np.ndarray, *rows: np.ndarray) -> list[np.ndarray]:
        """For each given row: occurrences of the symbol above it, by the wavelet levels."""
        at, base = [r.copy() for r in rows], np.zeros(len(symbol), np.int64)
        for (bit, bits), zeros in zip(self.levels, self.zeros):
            one = (symbol >> bit) & 1 != 0
            for k, i in enumerate([*at, base]):
                r = bits.rank(i)
                moved = np.where(one, zeros + r, i - r)
                if k < len(at):
                    at[k] = moved
                else:
                    base = moved
        return [i - base for i in at]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row interval of each pattern. ``patterns`` is right-aligned, padded with 0 on the left."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        # a pattern with a symbol that the text lacks has no row
        known = np.minimum(patterns, len(self.counts) - 1)
        absent = ((patterns >= len(self.counts)) | (self.counts[known] == 0)) & (patterns > 0)
        high[absent.any(axis=1)] = 0
        for k in range(1, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= k) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, -k]
            a, b = self.ranks(symbol, low[live], high[live])
            low[live], high[live] = self.before[symbol] + a, self.before[symbol] + b
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row, walking back to the next sampled suffix."""
        out, steps = np.empty(len(rows), np.int64), 0
        live, row = np.arange(len(rows)), rows.copy()
        while len(live):
            known = self.sampled.get(row)
            out[live[known]] = self.samples[self.sampled.rank(row[known])] + steps
            live, row = live[~known], row[~known]
            symbol, at, base = np.zeros(len(row), np.int64), row.copy(), np.zeros(len(row), np.int64)
            for (bit, bits), zeros in zip(self.levels, self.zeros):
                one = bits.get(at)
                symbol |= one.astype(np.int64) << bit
                at = np.where(one, zeros + bits.rank(at), at - bits.rank(at))
                base = np.where(one, zeros + bits.rank(base), base - bits.rank(base))
            row = self.before[symbol] + at - base
            steps += 1
        return out
