"""Byte-buffer helpers, bit slices, the FM-index and the cover sort against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from playerlake.llm import bit_slices, cover_sort
from playerlake.llm.columns import HASHER, NOT_SPACE, row_slices, text_buffer, word_spans
from playerlake.llm.fm_index import FMIndex


def test_words_do_not_cross_rows_and_nulls_are_empty():
    data, offsets = text_buffer(pa.array(["ab c", None, "", "d  e\n", "f"]))
    starts, ends = word_spans(data, offsets, NOT_SPACE)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == [b"ab", b"c", b"d", b"e", b"f"]
    assert list(np.diff(offsets)) == [4, 0, 0, 5, 1]


def test_sliced_arrays_keep_their_offsets():
    data, offsets = text_buffer(pa.array(["xx", "yy", "zzz"]).slice(1))
    assert bytes(data) == b"yyzzz" and list(offsets) == [0, 2, 5]


def test_slices_hold_whole_rows():
    offsets = np.array([0, 3, 3, 10, 12])
    assert list(row_slices(offsets, 4)) == [(0, 2), (2, 3), (3, 4)]


def test_equal_ranges_hash_alike_wherever_they_are():
    data = np.frombuffer(b"banana ban", np.uint8)
    h = HASHER.ranges(HASHER.prefix(data), np.array([0, 7, 1]), np.array([3, 10, 4]))
    assert h[0] == h[1] != h[2]


@pytest.mark.parametrize("seed", range(3))
def test_fm_index_finds_every_occurrence(seed):
    rng = random.Random(seed)
    runs = [[rng.randint(1, 3) for _ in range(rng.randint(1, 30))] for _ in range(40)]
    runs += runs[:5]
    symbols = np.array([s for run in runs for s in [*run, 0]], np.int64)
    index = FMIndex(symbols)
    patterns = [[rng.randint(1, 3) for _ in range(rng.randint(1, 6))] for _ in range(60)] + [[4], [1, 9], [700, 1]]
    width = 6
    padded = np.array([[0] * (width - len(p)) + p for p in patterns])
    low, high = index.search(padded, np.array([len(p) for p in patterns]))
    text = list(symbols)
    for p, a, b in zip(patterns, low, high):
        expected = [i for i in range(len(text) - len(p) + 1) if text[i : i + len(p)] == p]
        assert sorted(index.locate(np.arange(a, b))) == expected


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_bit_slices_find_all_close_pairs(radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for _ in range(300)]
    values = centres[rng.integers(0, 6, 300)] ^ np.array(flips, np.uint64)
    sizes = [1, 2, 130, 63, 64, 40]
    end = np.repeat(np.cumsum(sizes), sizes)
    found = {(int(i), int(j)) for a, b in bit_slices.close_pairs(values, end, radius) for i, j in zip(a, b)}
    expected = {(i, j) for i in range(300) for j in range(i + 1, int(end[i])) if int(values[i] ^ values[j]).bit_count() <= radius}
    assert found == expected


def test_cover_has_a_shift_for_every_pair_of_residues():
    assert cover_sort.SHIFT.shape == (31, 31) and cover_sort.SHIFT.max() <= 30


@pytest.mark.parametrize("seed", range(4))
def test_cover_sort_equals_comparing_all_prefixes(seed):
    rng = random.Random(seed)
    base = bytes(rng.choice(b"ab") for _ in range(900))
    parts = []
    for _ in range(12):
        part = bytearray(base[rng.randint(0, 60) : 900 - rng.randint(0, 60)])
        for _ in range(rng.randint(0, 2)):
            part[rng.randrange(len(part))] = ord("c")
        parts.append(bytes(part))
    text = np.frombuffer(b"".join(parts), np.uint8)
    starts, bucket, at = [], [], 0
    for k, part in enumerate(parts):
        starts += range(at, at + len(part) - 400 + 1)
        bucket += [k % 2] * (len(part) - 399)
        at += len(part)
    hit = cover_sort.repeated(text, np.array(starts), np.array(bucket))
    seen: dict = {}
    raw = text.tobytes()
    for s, b in zip(starts, bucket):
        seen.setdefault((b, raw[s : s + 400]), []).append(s)
    assert [len(seen[b, raw[s : s + 400]]) > 1 for s, b in zip(starts, bucket)] == list(hit)
