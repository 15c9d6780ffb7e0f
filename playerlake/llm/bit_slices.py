"""Hamming distances of 64-bit fingerprints, bit-sliced.

Bit planes are stored vertically: word w of plane p holds bit p of fingerprints
64 w to 64 w + 63. One query against one word compares 64 fingerprints at a time:
the differing bits of a plane are added to 64 counters held as carry-save bit
slices, and a word whose counters have all passed the radius is abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
PLANES_PER_ROUND = 8
COMPARISONS_PER_BLOCK = 1 << 17


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, words): the transposed bits of the fingerprints, zero-padded."""
    n_words = (len(values) + 63) // 64
    padded = np.zeros(n_words * 64, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _within(planes: np.ndarray, values: np.ndarray, query: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Surviving (comparison, lanes) of queries against words of 64 fingerprints."""
    at = np.arange(len(query))
    n_slices = max(1, radius.bit_length())
    # counters start so that the carry out of the top slice means "past the radius"
    start = (1 << n_slices) - 1 - radius
    counters = [np.full(len(query), ALL if start >> k & 1 else np.uint64(0), np.uint64) for k in range(n_slices)]
    for first in range(0, 64, PLANES_PER_ROUND):
        value, w = values[query], word
        for p in range(first, first + PLANES_PER_ROUND):
            bit = np.uint64(0) - ((value >> np.uint64(p)) & np.uint64(1))
            carry = planes[p, w] ^ bit
            for k in range(n_slices):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            lanes = lanes & ~carry
        live = np.flatnonzero(lanes)
        if len(live) < len(lanes):
            at, query, word, lanes = at[live], query[live], word[live], lanes[live]
            counters = [c[live] for c in counters]
        if not len(at):
            break
    return at, lanes


def close_pairs(values: np.ndarray, group_end: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j < group_end[i], whose fingerprints differ in at most ``radius`` bits.

    Rows of a group are consecutive; a row is compared with the later rows of its
    own group. Yields blocks of pairs; the work of a block is bounded.
    """
    n = len(values)
    planes = bit_planes(values)
    row = np.arange(n)
    first_word, last_word = (row + 1) >> 6, (group_end - 1) >> 6
    n_words = np.where(group_end > row + 1, last_word - first_word + 1, 0)
    done = np.cumsum(n_words)
    total, low = int(done[-1]) if n else 0, 0
    while low < total:
        # comparisons low..high, cut inside a long row where needed
        high = min(total, low + COMPARISONS_PER_BLOCK)
        number = np.arange(low, high)
        query = np.searchsorted(done, number, side="right")
        word = first_word[query] + number - (done[query] - n_words[query])
        lanes = np.full(len(query), ALL, np.uint64)
        head = np.flatnonzero(word == first_word[query])
        lanes[head] &= ALL << ((query[head] + 1) & 63).astype(np.uint64)
        tail = np.flatnonzero(word == last_word[query])
        lanes[tail] &= ALL >> (63 - (group_end[query[tail]] - 1 & 63)).astype(np.uint64)
        at, lanes = _within(planes, values, query, word, lanes, radius)
        if len(at):
            bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, lane = np.nonzero(bits)
            yield query[at[pair]], word[at[pair]] * 64 + lane
        low = high
