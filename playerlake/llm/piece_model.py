"""A SentencePiece BPE model as arrays: character map, symbols, merge ranks.

The model file's bytes are read once on the driver and broadcast; every Python
worker builds the tables once.
"""

from __future__ import annotations

import functools

import numpy as np
from sentencepiece import sentencepiece_model_pb2 as pb

SPACE = 0x2581  # the visible space that pieces carry
NO_RANK = np.int32(0x7FFFFFFF)
_NORMAL, _BYTE = 1, 6


class CharacterMap:
    """The compiled character map: a double-array trie over UTF-8 prefixes, and replacements."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], np.uint32).tolist()
        self.strings = blob[4 + size :]
        self.known: dict[int, str] = {}

    def longest(self, text: bytes, at: int) -> tuple[int, str] | None:
        """Length in bytes of the longest prefix with a rule at ``at``, and its replacement."""
        units, found = self.units, None
        node = self._offset(units[0])
        for length in range(1, len(text) - at + 1):
            byte = text[at + length - 1]
            node ^= byte
            if node >= len(units) or units[node] & 0x800000FF != byte:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = length, units[node] & 0x7FFFFFFF
        return found and (found[0], self._replacement(found[1]))

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _replacement(self, at: int) -> str:
        if at not in self.known:
            self.known[at] = self.strings[at : self.strings.index(b"\0", at)].decode()
        return self.known[at]

    @functools.cached_property
    def leads(self) -> np.ndarray:
        """First bytes that some rule starts with."""
        root = self._offset(self.units[0])
        return np.array([root ^ b < len(self.units) and self.units[root ^ b] & 0x800000FF == b for b in range(256)])


class PieceModel:
    def __init__(self, blob: bytes) -> None:
        model = pb.ModelProto()
        model.ParseFromString(blob)
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or 4 in kinds or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback and without user-defined pieces are supported")
        spec = model.normalizer_spec
        self.char_map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.dummy_prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        normal = {p.piece: k for k, p in enumerate(model.pieces) if p.type == _NORMAL}
        byte_ids = [next(k for k, p in enumerate(model.pieces) if p.type == _BYTE and int(p.piece[3:5], 16) == b) for b in range(256)]
        # symbols: all pieces, then single characters that are no piece but part of one
        names = list(normal) + sorted({c for piece in normal for c in piece} - normal.keys())
        symbol = {name: k for k, name in enumerate(names)}
        self.n_symbols = len(names)
        self.char_symbol = np.full(0x110000, -1, np.int32)
        for name, k in symbol.items():
            if len(name) == 1:
                self.char_symbol[ord(name)] = k
        # equal scores are equal ranks: the leftmost pair goes first then
        scores = sorted({model.pieces[k].score for k in normal.values()}, reverse=True)
        rank = {score: k for k, score in enumerate(scores)}
        rows = []
        bigrams = set()
        for piece, k in normal.items():
            bigrams.update(zip(piece, piece[1:]))
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is not None and b is not None:
                    rows.append((a << 32 | b, rank[model.pieces[k].score], symbol[piece]))
        pairs = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.pair_key, self.pair_rank, self.pair_symbol = pairs[:, 0], pairs[:, 1].astype(np.int32), pairs[:, 2].astype(np.int32)
        # adjacent characters that no piece holds always part
        chars = sorted({c for pair in bigrams for c in pair})
        self.char_class = np.zeros(self.n_symbols, np.int32)
        for k, c in enumerate(chars):
            self.char_class[symbol[c]] = k + 1
        self.joins = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in bigrams:
            self.joins[self.char_class[symbol[a]], self.char_class[symbol[b]]] = True
        # ids and lengths in characters of each symbol; a character without a piece becomes its bytes
        ids = [[normal[n]] if n in normal else [byte_ids[b] for b in n.encode()] for n in names]
        self.symbol_n_ids = np.array([len(x) for x in ids], np.int64)
        self.symbol_first_id = np.cumsum(self.symbol_n_ids) - self.symbol_n_ids
        self.symbol_ids = np.array([x for i in ids for x in i], np.int32)
        widths = [[len(n)] if n in normal else [0] * (len(n.encode()) - 1) + [1] for n in names]
        self.symbol_widths = np.array([x for w in widths for x in w], np.int32)
        self.byte_ids = np.array(byte_ids, np.int32)
        # bytes that an id decodes to
        spelled = [b""] * len(model.pieces)
        for k, p in enumerate(model.pieces):
            if p.type == _NORMAL:
                spelled[k] = p.piece.replace(chr(SPACE), " ").encode()
            elif p.type == _BYTE:
                spelled[k] = bytes([int(p.piece[3:5], 16)])
            elif p.type == 2:
                spelled[k] = " ⁇ ".encode()
        self.id_size = np.array([len(s) for s in spelled], np.int64)
        self.id_at = np.cumsum(self.id_size) - self.id_size
        self.id_bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.id_is_byte = np.zeros(len(spelled), bool)
        self.id_is_byte[self.byte_ids] = True
        self.id_has_space = np.array([p.type == _NORMAL and p.piece.startswith(chr(SPACE)) for p in model.pieces])

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; ``NO_RANK`` where nothing merges."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        same = self.pair_key[at] == key
        return np.where(same, self.pair_rank[at], NO_RANK), self.pair_symbol[at]

    # -- normalisation -------------------------------------------------------------

    def normalise(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points, their source bytes and row offsets of a batch of texts.

        ``source`` has one more entry than there are code points of all rows plus
        one per row: entry k + row is where code point k begins in ``data``, and a
        row's last entry is the end of its text. At each position the longest
        prefix with a rule in the character map is replaced; what it inserts is
        aligned to that prefix.
        """
        n_rows = len(offsets) - 1
        lead = (data & 0xC0) != 0x80
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        source = np.flatnonzero(lead)
        row = np.searchsorted(offsets, source, side="right") - 1
        if self.char_map is not None and len(points):
            points, source, row = self._mapped(data, points, source, row, offsets)
        if self.squeeze and len(points):
            space = points == 0x20
            before = np.r_[True, space[:-1] | (row[1:] != row[:-1])]
            keep = ~(space & before)
            points, source, row, space = points[keep], source[keep], row[keep], space[keep]
            last = np.r_[row[1:] != row[:-1], True] if len(row) else np.zeros(0, bool)
            keep = ~(space & last)
            points, source, row = points[keep], source[keep], row[keep]
        if self.escape:
            points = np.where(points == 0x20, SPACE, points)
        counts = np.bincount(row, minlength=n_rows).astype(np.int64)
        add = ((counts > 0) & self.dummy_prefix).astype(np.int64)
        row_at = np.concatenate([[0], np.cumsum(counts + add)])
        first = np.cumsum(counts) - counts
        place = np.arange(len(points)) - first[row] + row_at[row] + add[row]
        full = np.full(int(row_at[-1]), SPACE, np.int64)
        full[place] = points
        aligned = np.empty(int(row_at[-1]) + n_rows, np.int64)
        rows_of = np.repeat(np.arange(n_rows), counts + add)
        aligned[np.arange(len(full)) + rows_of] = offsets[:-1][rows_of]  # an inserted prefix begins with the text
        aligned[place + row] = source
        aligned[row_at[1:] + np.arange(n_rows)] = offsets[1:]
        return full, aligned, row_at

    def _mapped(self, data, points, source, row, offsets):
        """Replace longest prefixes; only positions whose first byte starts a rule are walked."""
        text = data.tobytes()
        edit_at, edit_len, edit_new = [], [], []
        done = 0
        for k in np.flatnonzero(self.char_map.leads[data[source]]).tolist():
            at = int(source[k])
            if at < done:
                continue
            found = self.char_map.longest(text[at : int(offsets[row[k] + 1])], 0)
            if found:
                edit_at.append(k)
                edit_len.append(len(text[at : at + found[0]].decode()))
                edit_new.append(found[1])
                done = at + found[0]
        if not edit_at:
            return points, source, row
        at, removed = np.array(edit_at), np.array(edit_len)
        grown = np.ones(len(points), np.int64)
        for k in range(int(removed.max())):
            grown[at[removed > k] + k] = 0
        grown[at] = [len(s) for s in edit_new]
        index = np.repeat(np.arange(len(points)), grown)
        out = points[index]
        where = np.cumsum(grown) - grown
        fill = np.concatenate([where[a] + np.arange(len(s)) for a, s in zip(edit_at, edit_new)]).astype(np.int64)
        out[fill] = [ord(c) for s in edit_new for c in s]
        return out, source[index], row[index]


@functools.lru_cache(maxsize=4)
def piece_model(blob: bytes) -> PieceModel:
    return PieceModel(blob)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
