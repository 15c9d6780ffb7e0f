"""Rank-synchronous byte-pair merging of many pre-tokens as ragged arrays.

Pre-tokens lie one after the other in a flat symbol array. In each step every
sequence merges its own lowest-rank pair, all sequences at once, and finished
sequences leave the arrays. A sequence merges all occurrences of its lowest pair
together where that provably equals merging them one by one from the left; where
a merge would open a pair of the same or a lower rank, it merges the leftmost
only.
"""

from __future__ import annotations

import heapq

import numpy as np

from playerlake.llm.columns import HASHER, ragged
from playerlake.llm.piece_model import NO_RANK, PieceModel

#: Longer sequences merge by a heap: steps over arrays would be few symbols each.
LONG = 1024


def _merge_long(model: PieceModel, symbols: list[int]) -> list[int]:
    """One long sequence, lowest rank first, leftmost among equals."""
    n = len(symbols)
    nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n

    def push(i: int) -> None:
        j = nxt[i]
        if j < n:
            key = symbols[i] << 32 | symbols[j]
            k = int(np.searchsorted(model.pair_key, key))
            if k < len(model.pair_key) and model.pair_key[k] == key:
                heapq.heappush(heap, (int(model.pair_rank[k]), i, symbols[i], symbols[j], int(model.pair_symbol[k])))

    heap: list[tuple[int, int, int, int, int]] = []
    for i in range(n - 1):
        push(i)
    while heap:
        _, i, left, right, merged = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if j >= n or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i], alive[j], nxt[i] = merged, False, nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        push(i)
        if prev[i] >= 0:
            push(prev[i])
    return [s for s, a in zip(symbols, alive) if a]


def merge(model: PieceModel, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Surviving symbols and their number for each sequence."""
    n_seq = len(lengths)
    starts = np.cumsum(lengths) - lengths
    results: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # sequences, lengths, symbols

    long = np.flatnonzero(lengths > LONG)
    for s in long:
        out = np.array(_merge_long(model, symbols[starts[s] : starts[s] + lengths[s]].tolist()), np.int32)
        results.append((np.array([s]), np.array([len(out)]), out))
    seqs = np.flatnonzero(lengths <= LONG)
    size = lengths[seqs]
    sym = symbols[ragged(starts[seqs], size)].astype(np.int32)

    def ranks(sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank = np.full(len(sym), NO_RANK, np.int32)
        into = np.zeros(len(sym), np.int32)
        if len(sym) > 1:
            rank[:-1], into[:-1] = model.pair(sym[:-1], sym[1:])
        rank[np.cumsum(size) - 1] = NO_RANK  # a last symbol has no partner
        return rank, into

    empty = size == 0
    if empty.any():
        results.append((seqs[empty], size[empty], np.zeros(0, np.int32)))
        seqs, size = seqs[~empty], size[~empty]
    rank, into = ranks(sym, size)
    while len(seqs):
        start = np.cumsum(size) - size
        least = np.minimum.reduceat(rank, start)
        over = least == NO_RANK
        if over.any():
            results.append((seqs[over], size[over], sym[np.repeat(over, size)]))
            live = np.repeat(~over, size)
            sym, rank, into = sym[live], rank[live], into[live]
            seqs, size, least = seqs[~over], size[~over], least[~over]
            if not len(seqs):
                break
            start = np.cumsum(size) - size
        n = len(sym)
        of = np.repeat(np.arange(len(seqs)), size)
        hit = np.flatnonzero(rank == least[of])
        # of overlapping pairs every other one, from the left
        run = np.r_[True, (hit[1:] != hit[:-1] + 1) | (of[hit[1:]] != of[hit[:-1]])]
        at_run = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - at_run) % 2 == 0]
        first = np.r_[True, of[hit[1:]] != of[hit[:-1]]]
        several = ~(first & np.r_[first[1:], True])
        if several.any():
            # would a pair next to a merge come first? right neighbour as it is, left neighbour as merged
            t = hit[several]
            merged = np.full(n + 2, -1, np.int64)
            merged[t] = into[t]
            new = into[t]
            right = np.minimum(t + 2, n - 1)
            r1, _ = model.pair(new, sym[right])
            r1 = np.where((t + 2 < n) & (of[right] == of[t]), r1, NO_RANK)
            left = np.maximum(t - 1, 0)
            left_sym = np.where((t >= 2) & (merged[t - 2] >= 0) & (of[np.maximum(t - 2, 0)] == of[t]), merged[t - 2], sym[left])
            r2, _ = model.pair(left_sym, new)
            r2 = np.where((t >= 1) & (of[left] == of[t]), r2, NO_RANK)
            early = np.unique(of[t[np.minimum(r1, r2) <= least[of[t]]]])
            if len(early):
                one = np.zeros(len(seqs), bool)
                one[early] = True
                hit = hit[first | ~one[of[hit]]]
        sym[hit] = into[hit]
        keep = np.ones(n, bool)
        keep[hit + 1] = False
        size = size - np.bincount(of[hit], minlength=len(seqs))
        changed = np.zeros(n, bool)
        changed[hit] = True
        sym, rank, into, changed = sym[keep], rank[keep], into[keep], changed[keep]
        redo = np.flatnonzero(changed | np.r_[changed[1:], False])
        last = np.zeros(len(sym), bool)
        last[np.cumsum(size) - 1] = True
        partner = sym[np.minimum(redo + 1, len(sym) - 1)]
        r, m = model.pair(sym[redo], partner)
        rank[redo], into[redo] = np.where(last[redo], NO_RANK, r), m

    out_len = np.zeros(n_seq, np.int64)
    for s, k, _ in results:
        out_len[s] = k
    out_at = np.cumsum(out_len) - out_len
    out = np.empty(int(out_len.sum()), np.int32)
    for s, k, x in results:
        out[ragged(out_at[s], k)] = x
    return out, out_len


def pre_tokens(model: PieceModel, points: np.ndarray, row_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Initial symbols and starts of pre-tokens: cut wherever no piece spans the place."""
    symbols = model.char_symbol[points]
    n = len(points)
    if not n:
        return symbols, np.zeros(0, np.int64)
    cls = np.where(symbols >= 0, model.char_class[np.maximum(symbols, 0)], 0)
    cut = np.ones(n, bool)
    cut[1:] = ~model.joins[cls[:-1], cls[1:]]
    cut[row_at[row_at < n]] = True
    return symbols, np.flatnonzero(cut)


def distinct_tokens(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, which): an occurrence of each distinct pre-token, and the distinct one of each pre-token."""
    n = len(symbols)
    lengths = np.diff(np.r_[starts, n])
    hashes = HASHER.ranges(HASHER.prefix(symbols), starts, starts + lengths)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    # equal hashes must be equal symbols; a pre-token that differs stands for itself
    model_of = first[which]
    same = lengths == lengths[model_of]
    check = np.where(same, lengths, 0)
    equal = symbols[ragged(starts, check)] == symbols[ragged(starts[model_of], check)]
    same[np.repeat(np.arange(len(starts)), check)[~equal]] = False
    odd = np.flatnonzero(~same)
    which[odd] = len(first) + np.arange(len(odd))
    return np.r_[first, odd], which
