"""Ids of whole texts under a word-level BPE file of the tokenizers library.

For files that lower-case, drop white space and take runs of letters, single digits
and runs of marks, as word_bpe_49k.json does. No pre-token crosses white space, nor
the border between a Latin letter or a digit and an ASCII mark other than an
apostrophe (which may begin a contraction) or a bar (which stands in special tokens).
Texts are cut there, and the library encodes each distinct cut once: a worker process
keeps the cuts that it has seen lately. A cut of Latin letters is one pre-token, which
goes to the library's model at once; others take its whole way. Cuts of a slice are
told apart by a 64-bit hash of their bytes.
"""

from __future__ import annotations

import functools
import os
from array import array

import numpy as np

from playerlake.llm.columns import HASHER, LOWER, ragged

#: Cuts that a process remembers, in each of two generations.
REMEMBERED = 400_000

#: Class of each byte: 0 white space, 1 letter, 2 digit, 3 mark, 4 never a border.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[48:58] = 2
_CLASS[[*b"'|", *range(128, 256)]] = 4
_BORDER = np.zeros((5, 5), bool)
_BORDER[1:4, 1:4] = ~np.eye(3, dtype=bool)
#: Second bytes, after 0xC3, of the Latin letters from U+00C0 to U+00FF; the first 30 are upper case.
_LATIN = (np.arange(256) >> 6 == 2) & ~np.isin(np.arange(256), (0x97, 0xB7))
_UPPER = _LATIN & (np.arange(256) < 0x9F)


def _kinds(data: np.ndarray) -> np.ndarray:
    """The class of each byte; both bytes of a Latin letter are letters."""
    kind = _CLASS[data]
    latin = np.flatnonzero((data[:-1] == 0xC3) & _LATIN[data[1:]])
    kind[latin] = kind[latin + 1] = 1
    return kind


def cuts(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every cut of each row."""
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = kind > 0
    border = np.ones(len(kind) + 1, bool)
    border[1:-1] = _BORDER[kind[:-1], kind[1:]] | ~word[:-1] | ~word[1:]
    border[offsets] = True
    return np.flatnonzero(border[:-1] & word), np.flatnonzero(border[1:] & word) + 1


def _byte_symbols() -> np.ndarray:
    """The character that byte-level models write for each byte: itself if visible, else one from U+0100; a line end stays."""
    symbols = np.arange(256, dtype="<u2")
    hidden = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or b >= 0xAE)]
    symbols[hidden] = 256 + np.arange(len(hidden))
    symbols[10] = 10
    return symbols


class WordEncoder:
    """The library's ids of many texts at once."""

    def __init__(self, blob: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(blob)
        self.model = self.library.model
        self.symbols = _byte_symbols()
        self.young: dict[int, bytes] = {}
        self.old: dict[int, bytes] = {}

    def _encode_new(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray) -> list[bytes]:
        """Ids of the given ranges; ``letters``: lower-case Latin letters only."""
        out: list = [None] * len(starts)
        lines = np.full(int((ends - starts).sum()) + len(starts), 10, np.uint8)
        edges = np.cumsum(ends - starts + 1) - (ends - starts + 1)
        lines[ragged(edges, ends - starts)] = body[ragged(starts, ends - starts)]
        symbols = self.symbols[lines].tobytes().decode("utf-16-le").split("\n")
        tokenize = self.model.tokenize
        for k in np.flatnonzero(letters).tolist():
            out[k] = array("I", [token.id for token in tokenize(symbols[k])]).tobytes()
        words, rest = lines.tobytes().split(b"\n"), np.flatnonzero(~letters).tolist()
        for k, found in zip(rest, self.library.encode_batch_fast([words[k].decode() for k in rest], add_special_tokens=False)):
            out[k] = array("I", found.ids).tobytes()
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of rows) of well-formed UTF-8 texts."""
        kind = _kinds(data)
        starts, ends = cuts(kind, offsets)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        # cuts of ASCII and Latin letters are equal without case; others may compose with marks first
        lowered = LOWER[data]
        lowered[1:] += np.uint8(32) * ((data[:-1] == 0xC3) & _UPPER[data[1:]])
        odd = np.concatenate([[0], np.cumsum((kind == 4) & (data != ord("'")))])
        other = np.concatenate([[0], np.cumsum(kind != 1)])
        raw = np.flatnonzero(odd[ends] != odd[starts])
        at = ragged(starts[raw], (ends - starts)[raw])
        lowered[at] = data[at]
        hashes = HASHER.ranges(HASHER.prefix(lowered), starts, ends)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        keys = keys.tolist()
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        known = list(map(self.young.get, keys))
        if missing := [k for k, x in enumerate(known) if x is None]:
            before = list(map(self.old.get, [keys[k] for k in missing]))
            new = np.array([first[k] for k, x in zip(missing, before) if x is None], np.int64)
            found = iter(self._encode_new(lowered, starts[new], ends[new], other[ends[new]] == other[starts[new]]))
            for k, x in zip(missing, before):
                known[k] = self.young[keys[k]] = next(found) if x is None else x
        ids = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        begins = np.cumsum(sizes) - sizes
        out = ids[ragged(begins[which], sizes[which])]
        upto = np.concatenate([[0], np.cumsum(sizes[which])])
        return out, upto[np.searchsorted(starts, offsets)]


@functools.lru_cache(maxsize=2)
def word_encoder(blob: bytes) -> WordEncoder:
    return WordEncoder(blob)
