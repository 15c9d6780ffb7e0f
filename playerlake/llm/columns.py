"""Text columns as numpy byte buffers inside Arrow tasks.

A text column arrives as one ``uint8`` buffer plus row offsets. The helpers find
words, hash them and address ragged ranges for a whole batch at once, so no
Python code runs per word. Batches are cut into slices of bounded bytes; a text
longer than the bound is a slice of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

#: Settings that bound one Arrow batch; applied only where the cluster set none.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def bound_batches(spark) -> None:
    for key, value in BATCH_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    n, low = len(offsets) - 1, 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges [start, start + length)."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(np.asarray(starts, np.int64) - before, lengths) + np.arange(total)


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of ``is_word`` bytes inside a row."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = is_word[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    last = np.empty(n, bool)
    last[-1], last[:-1] = True, ~word[1:]
    ends = np.flatnonzero(word & (last | edge[1:])) + 1
    return starts, ends


class Hasher:
    """Polynomial hashes of byte ranges mod 2**64; power tables are kept per process."""

    base = 0x9E3779B97F4A7C15  # odd, so that it has an inverse

    def __init__(self) -> None:
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(n + 1, SLICE_BYTES + 1)
            with np.errstate(over="ignore"):
                up, down = np.full(size, self.base, np.uint64), np.full(size, pow(self.base, -1, 1 << 64), np.uint64)
                up[0] = down[0] = 1
                self.powers, self.inverses = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """sums[i]: hash of the first i bytes, not yet moved to a common origin."""
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each byte range, mixed so that the high bits are usable."""
        h = (sums[ends] - sums[starts]) * self.inverses[starts]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return h


HASHER = Hasher()

#: ASCII upper case to lower case, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words that white space (space, tab to carriage return) separates.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
