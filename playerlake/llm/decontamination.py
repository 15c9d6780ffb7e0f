"""Benchmark decontamination by an FM-index per training shard.

A shard is a run of whole documents of bounded bytes inside one task. Its words
become symbols of the benchmark's vocabulary. Only maximal runs of vocabulary
words that are long enough for some window can hold an occurrence, so the index
covers exactly these runs. Every window of the benchmark is searched backwards
through the wavelet ranks, occurrences are located by sampled suffixes, and the
hit words merge into removal spans. Documents are never shuffled.

The benchmark is the stated query set: it is cut into blocks of proven size, and
each block is one broadcast and one pass of the same tasks. With several blocks a
pass is saved and its broadcast freed before the driver takes the next block.

Words: A-Z lower-cased, runs of digits, letters and any character above ASCII.
A window is ``window`` consecutive words of an item; an item of fewer words, but
not none, is one window.

Defined results: null or empty text has no words and no hits; texts of any length are
searched whole; null or empty items have no windows, an item without an id counts
under the empty id; repeated documents and items count like any other; without items
nothing is hit, without documents the result is empty. Other columns pass through; a column named like a result is
replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerlake.llm.columns import HASHER, LOWER, bound_batches, ragged, row_slices, text_buffer, word_spans
from playerlake.llm.fm_index import FMIndex
from playerlake.llm.storage import remove_scratch, saved, scratch_folders

WINDOW = 10
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 8 << 20

IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
IS_WORD_ANY_CASE = IS_WORD.copy()
IS_WORD_ANY_CASE[0x41:0x5B] = True

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.LongType())),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
])


class Windows:
    """Vocabulary and distinct windows of one benchmark block."""

    def __init__(self, block: list[tuple[str, bytes]], window: int) -> None:
        data = LOWER[np.frombuffer(b"\n".join(t for _, t in block) or b"", np.uint8)]
        lengths = np.array([len(t) for _, t in block], np.int64)
        begins = np.cumsum(lengths + 1) - (lengths + 1) if len(block) else np.zeros(0, np.int64)
        starts, ends = word_spans(data, np.array([0, len(data)]), IS_WORD)
        words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
        codes: dict[bytes, int] = {}
        sequence = np.array([codes.setdefault(w, len(codes) + 1) for w in words], np.int64)
        item_of = np.searchsorted(begins, starts, side="right") - 1
        found: dict[tuple[int, ...], set[int]] = {}
        bounds = np.searchsorted(item_of, np.arange(len(block) + 1))
        for item, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a < b:
                for i in range(a, max(a, b - window) + 1):
                    found.setdefault(tuple(sequence[i : min(i + window, b)]), set()).add(item)
        self.names = [name for name, _ in block]
        self.items = [sorted(v) for v in found.values()]
        self.lengths = np.array([len(k) for k in found], np.int64)
        self.patterns = np.zeros((len(found), window), np.int64)
        for row, k in zip(self.patterns, found):
            row[window - len(k) :] = k
        self.shortest = int(self.lengths.min(initial=window))
        vocabulary = list(codes)
        self.spelling = np.frombuffer(b"".join(vocabulary) or b"", np.uint8)
        self.size = np.array([0, *map(len, vocabulary)], np.int64)
        self.at = np.cumsum(self.size) - self.size
        hashes = np.array([], np.uint64)
        if vocabulary:
            sums = HASHER.prefix(self.spelling)
            hashes = HASHER.ranges(sums, self.at[1:], self.at[1:] + self.size[1:])
        order = np.argsort(hashes)
        self.hashes, self.codes = hashes[order], order + 1
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def encode(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary code of each hash, 0 for none."""
        out = np.zeros(len(hashes), np.int64)
        some = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        if len(some):
            h = hashes[some]
            i = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            out[some] = np.where(self.hashes[i] == h, self.codes[i], 0)
        return out


def _long_runs(codes: np.ndarray, doc_of: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of non-zero codes inside a document, of at least ``least`` words."""
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.r_[True, (codes[1:] == 0) | (codes[:-1] == 0) | (doc_of[1:] != doc_of[:-1])]
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.r_[starts, len(codes)])
    keep = (codes[starts] != 0) & (lengths >= least)
    return starts[keep], lengths[keep]


def _true_words(w: Windows, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether each word is spelt like its code's vocabulary word, not only hashed like it."""
    same = (ends - starts) == w.size[codes]
    lengths = np.where(same, ends - starts, 0)
    equal = LOWER[data[ragged(starts, lengths)]] == w.spelling[ragged(w.at[codes], lengths)]
    wrong = np.repeat(np.arange(len(codes)), lengths)[~equal]
    same[wrong] = False
    return same


class Shard:
    """Words of the shard's documents as vocabulary codes."""

    def __init__(self) -> None:
        self.codes, self.doc_of, self.place, self.begin, self.end = [], [], [], [], []
        self.n_words: list[np.ndarray] = []
        self.rows = 0

    def add(self, w: Windows, data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends = word_spans(data, offsets, IS_WORD_ANY_CASE)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        self.n_words.append(np.bincount(doc, minlength=len(offsets) - 1))
        if len(w.hashes) and len(starts):
            codes = w.encode(HASHER.ranges(HASHER.prefix(LOWER[data]), starts, ends))
            while True:
                first, length = _long_runs(codes, doc, w.shortest)
                at = ragged(first, length)
                true = _true_words(w, data, starts[at], ends[at], codes[at])
                if true.all():
                    break
                codes[at[~true]] = 0
            # each run is followed by a terminator
            to = np.arange(len(at)) + np.repeat(np.arange(len(first)), length)
            word = at - np.searchsorted(doc, doc[at])
            for kept, values in ((self.codes, codes[at]), (self.doc_of, doc[at] + self.rows), (self.place, word), (self.begin, starts[at] - offsets[doc[at]]), (self.end, ends[at] - offsets[doc[at]])):
                full = np.zeros(len(at) + len(first), np.int64)
                full[to] = values
                kept.append(full)
        self.rows += len(offsets) - 1

    def hits(self, w: Windows) -> tuple[np.ndarray, list[list[int]], list[list[str]]]:
        """Per document: its words, flat spans (see ``RESULT``), names of items."""
        n_words = np.concatenate(self.n_words) if self.n_words else np.zeros(0, np.int64)
        spans: list[list[int]] = [[] for _ in range(self.rows)]
        items: list[list[str]] = [[] for _ in range(self.rows)]
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.int32)
        if not len(codes):
            return n_words, spans, items
        doc_of, place, begin, end = (np.concatenate(x) for x in (self.doc_of, self.place, self.begin, self.end))
        index = FMIndex(codes)
        low, high = index.search(w.patterns, w.lengths)
        many = high - low
        found = index.locate(ragged(low, many))
        which = np.repeat(np.arange(len(low)), many)
        cover = np.zeros(len(codes) + 1, np.int64)
        np.add.at(cover, found, 1)
        np.add.at(cover, found + w.lengths[which], -1)
        hit = np.cumsum(cover[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
        for a, b in zip(edges[::2], edges[1::2]):  # a terminator parts runs, so a span is inside a document
            spans[doc_of[a]] += [int(begin[a]), int(end[b - 1]), int(place[a]), int(place[b - 1]) + 1]
        for pair in np.unique(doc_of[found] * len(w.items) + which):
            doc, k = divmod(int(pair), len(w.items))
            items[doc] += [w.names[i] for i in w.items[k]]
        return n_words, spans, items


def _merged(spans: list[int]) -> list[int]:
    """Flat spans (byte begin, byte end, word begin, word end) without overlaps, in order."""
    out: list[list[int]] = []
    for span in sorted(spans[i : i + 4] for i in range(0, len(spans), 4)):
        if out and span[2] <= out[-1][3]:
            out[-1][1], out[-1][3] = max(out[-1][1], span[1]), max(out[-1][3], span[3])
        else:
            out.append(span)
    return [x for span in out for x in span]


def _search(broadcast, window: int, text_col: str, kept: list[str], carry: bool):
    """mapInArrow function: adds or extends the result columns for one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Windows(broadcast.value, window)
        held: list[pa.RecordBatch] = []
        shard, size = Shard(), 0

        def flush() -> Iterator[pa.RecordBatch]:
            n_words, spans, items = shard.hits(w)
            at = 0
            for batch in held:
                n = batch.num_rows
                s, i = spans[at : at + n], items[at : at + n]
                if carry:
                    s = [a + b for a, b in zip(batch.column("hit_spans").to_pylist(), s)]
                    i = [a + b for a, b in zip(batch.column("hit_items").to_pylist(), i)]
                s, i = [_merged(x) for x in s], [sorted(set(x)) for x in i]
                n_hit = [sum(x[3::4]) - sum(x[2::4]) for x in s]
                columns = [batch.column(c) for c in kept]
                columns += [pa.array(n_words[at : at + n], pa.int64()), pa.array(n_hit, pa.int64()), pa.array(s, pa.list_(pa.int64())), pa.array(i, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *RESULT.names])
                at += n

        for batch in batches:
            data, offsets = text_buffer(batch.column(text_col))
            for a, b in row_slices(offsets):
                shard.add(w, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            held.append(batch)
            size += len(data)
            if size >= SHARD_BYTES:
                yield from flush()
                held, shard, size = [], Shard(), 0
        if held:
            yield from flush()

    return run


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int = BLOCK_BYTES) -> tuple[int, Iterator[list[tuple[str, bytes]]]]:
    """The number of blocks of bounded size, and the query set block by block.

    Items are cut into overlapping pieces of at most ``block_bytes`` / 16 bytes on
    the executors, so even one huge item spreads over blocks; the number of
    blocks comes from the measured total of texts and ids. Pieces are dealt by id
    and text, so many ids that share a text spread over blocks too. The pieces are
    saved once, and the driver holds one block at a time.
    """
    piece = max(1024, block_bytes // 16)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    schema = "item string, text binary, size long, part long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            rows = []
            for k, item in enumerate(batch.column("item").to_pylist()):
                text = data[offsets[k] : offsets[k + 1]]
                starts, ends = word_spans(text, np.array([0, len(text)]), IS_WORD_ANY_CASE)
                a = 0
                while a < len(starts):
                    b = max(int(np.searchsorted(ends, starts[a] + piece, side="right")), a + window)
                    b = min(b, len(starts))
                    body = text[starts[a] : ends[b - 1]].tobytes()
                    rows.append((item, body, len(body) + len(item.encode()), len(rows)))
                    if b == len(starts):
                        break
                    a = b - window + 1
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ([],) * 4, (pa.string(), pa.binary(), pa.int64(), pa.int64()))], names=["item", "text", "size", "part"])

    pieces = saved(items.mapInArrow(cut, schema).dropDuplicates(["item", "text"]), "benchmark-pieces")
    total = pieces.agg(F.sum("size")).collect()[0][0] or 0
    count = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    return count, ([(r.item, bytes(r.text)) for r in pieces.where(block == k).select("item", "text").collect()] for k in range(count))


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, keep_text: bool = True) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_spans and hit_items.

    hit_spans is flat, four numbers a span: byte begin, byte end, word begin, word
    end. Without ``keep_text`` the text column is left out of the result.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    results = {name.lower() for name in RESULT.names}
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in results])
    fields = out.schema.fields
    count, blocks = benchmark_blocks(benchmark, item_col, item_text_col, window)
    done: list[str] = []
    for k, block in enumerate(blocks):
        kept = [f for f in fields if keep_text or k + 1 < count or f.name != text_col]
        shared = spark.sparkContext.broadcast(block)
        out = out.mapInArrow(_search(shared, window, text_col, [f.name for f in kept], k > 0), T.StructType([*kept, *RESULT.fields]))
        if k + 1 < count:  # this pass is over before the next block is fetched
            with scratch_folders() as folders:
                out = saved(out, "searched", compression="zstd")
            shared.destroy()
            remove_scratch(spark, done)
            done = folders
    return out


def remove_contamination(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """``find_contamination`` with the hit spans cut out of the text; null stays null."""
    found = find_contamination(docs, benchmark, text_col=text_col, **options)
    cut = F.expr(f"""
        cast(concat(
            aggregate(sequence(0, size(hit_spans) div 4 - 1), cast('' as binary), (kept, i) -> concat(kept,
                substring(cast(`{text_col}` as binary), if(i = 0, 0, cast(get(hit_spans, 4 * i - 3) as int)) + 1,
                          cast(hit_spans[4 * i] as int) - if(i = 0, 0, cast(get(hit_spans, 4 * i - 3) as int))))),
            substring(cast(`{text_col}` as binary), cast(hit_spans[size(hit_spans) - 3] as int) + 1)) as string)""")
    return found.withColumn(text_col, F.when(F.col("n_hit") > 0, cut).otherwise(F.col(text_col)))
