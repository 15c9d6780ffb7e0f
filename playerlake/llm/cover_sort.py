"""Repeated prefixes of suffixes, bucket by bucket, with a difference cover.

A block of text holds the suffixes of some buckets. Positions whose residue is in
a difference cover are ranked first, by doubling within the cover. Suffixes of a
bucket are grouped by short prefixes; for two of a long tie the cover has a
distance after which both lie on ranked positions, so one comparison of ranks
decides. Ties split around pivots, all groups at once, until suffixes are equal in
``LENGTH`` bytes or apart. Memory follows the block, not the corpus.
"""

from __future__ import annotations

import numpy as np

LENGTH = 400

#: A perfect difference set; every difference of residues occurs once.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)

_IN_COVER = np.isin(np.arange(MODULUS), COVER)
#: SHIFT[a, b]: smallest distance that takes residues a and b into the cover together.
SHIFT = np.array([[next(d for d in range(MODULUS) if _IN_COVER[(a + d) % MODULUS] and _IN_COVER[(b + d) % MODULUS]) for b in range(MODULUS)] for a in range(MODULUS)])

# Bytes of a suffix that decide: 31 at its start, 341 from the shift (at most 30), and the last 62.
DEPTH = 11 * MODULUS
TAIL = LENGTH - 2 * MODULUS


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Dense rank of each row of keys, in lexicographic order."""
    out = keys[0]
    for key in keys[1:]:
        out = out.astype(np.int64) << 32 | key
    order = np.argsort(out)
    ordered = out[order]
    rank = np.empty(len(out), np.int32)
    rank[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
    return rank


def repeated(text: np.ndarray, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether the ``LENGTH`` bytes at each start also begin at another start of its bucket.

    ``starts`` are positions with at least ``LENGTH`` bytes left; ``bucket`` is a
    number of each start's bucket.
    """
    flagged = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return flagged
    n = len(text)
    padded = np.zeros(n + LENGTH + 2 * MODULUS, np.uint8)
    padded[:n] = text
    m = n + LENGTH
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[: m + MODULUS].copy().view(">u8")[:, 0].astype(np.uint64)
    eight = _ranks(words)
    sixteen = _ranks(eight[:-8], eight[8:])
    short = _ranks(sixteen[: m - LENGTH], sixteen[15 : m - LENGTH + 15])  # 31 bytes at each position of the text

    # ranks of cover positions by doubling: a multiple of the modulus stays in the cover
    cover = np.flatnonzero(_IN_COVER[np.arange(n) % MODULUS])
    rank = np.zeros(n + LENGTH, np.int32)
    rank[cover] = short[cover] + 1
    for step in (1, 2, 4, 3):
        rank[cover] = _ranks(rank[cover], rank[cover + step * MODULUS]) + 1

    item = np.arange(len(starts))
    group = _ranks(_ranks(bucket.astype(np.int64), short[starts]), _ranks(short[starts + TAIL], short[starts + TAIL + MODULUS]))
    while len(item):
        order = np.argsort(group, kind="stable")
        item, group = item[order], group[order]
        first = np.r_[True, group[1:] != group[:-1]]
        alone = first & np.r_[first[1:], True]
        item, group, first = item[~alone], group[~alone], first[~alone]
        if not len(item):
            break
        at = starts[item]
        where = np.flatnonzero(first)
        size = np.diff(np.r_[where, len(item)])
        middle = np.repeat(where + size // 2, size)
        pivot = at[middle]
        shift = SHIFT[at % MODULUS, pivot % MODULUS]
        side = np.sign(rank[at + shift].astype(np.int64) - rank[pivot + shift])
        equal = side == 0
        many = np.repeat(np.add.reduceat(equal, where), size) > 1
        flagged[item[equal & many]] = True
        number = np.repeat(np.arange(len(where)), size)
        item, group = item[~equal], (2 * number + (side > 0))[~equal]
    return flagged
