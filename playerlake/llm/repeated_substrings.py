"""Removal of long repeated byte strings across documents, by suffix buckets.

A byte is removed if a ``LENGTH``-byte string that covers it also starts anywhere
else. The suffixes of the corpus fall into buckets by the minimizer of their first
``LENGTH`` bytes: equal strings have equal minimizers, and neighbouring suffixes
share theirs, so a run of suffixes is one record. Only minimizers that occur twice
go on. Equal records collapse by a hash of their bytes: all their suffixes are
repeated, and one of them stands for all in its bucket. These representatives
carry bytes. A task takes one bucket after the other and resolves its ties by a
difference cover (``cover_sort``) in blocks of bounded size.

A bucket with over ``BUCKET`` different records is too large for a task. Its
records are split again by a longer minimizer, and what is still too large is
counted by a 128-bit hash of each suffix's ``LENGTH`` bytes, map-side first.

Texts are shuffled once: those with a shared run are saved with the runs whose bytes
are needed, and records, splits and hashes are made from there. The cut moves only
these texts again.

Equal texts are one text: copies meet map-side, and a text that has copies is removed
whole, without its bytes. Texts are identified by two 64-bit hashes, records by their
minimizer's and their own.

Defined results: null text is empty; texts under ``LENGTH`` bytes keep all;
repeated rows are copies of each other; without rows the result is empty; other
columns pass through, one named like a result is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerlake.llm.columns import Hasher, bound_batches, ragged, row_slices, text_buffer
from playerlake.llm.cover_sort import LENGTH, repeated
from playerlake.llm.storage import saved

GRAM = 64
LONG_GRAM = 256
BUCKET = 4096
BLOCK = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)

HASHER = Hasher()


class _SecondHasher(Hasher):
    """Another multiplier, for the other half of a 128-bit hash."""

    base = 0xC2B2AE3D27D4EB4F


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(values) - width + 1
    size = -(-len(values) // width) * width
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def suffix_runs(data: np.ndarray, offsets: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, start in the row, number of suffixes, minimizer, record) of runs with one minimizer.

    The last two are hashes: of the minimizer's ``gram`` bytes and of all the
    run's suffixes' first bytes.
    """
    if len(data) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums = HASHER.prefix(data)
    at = np.arange(len(data) - gram + 1)
    grams = HASHER.ranges(sums, at, at + gram)
    # equal grams in a window: the leftmost
    least = _window_minima((grams & ~_PLACE) | at.astype(np.uint64), LENGTH - gram + 1)
    chosen = (least & _PLACE).astype(np.int64)
    room = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    starts = ragged(offsets[:-1], room)
    if not len(starts):
        return suffix_runs(data[:0], offsets[:1])
    minimizer = chosen[starts]
    first = np.flatnonzero(np.r_[True, (minimizer[1:] != minimizer[:-1]) | (starts[1:] != starts[:-1] + 1)])
    row = np.searchsorted(offsets, starts[first], side="right") - 1
    n = np.diff(np.r_[first, len(starts)])
    record = HASHER.ranges(sums, starts[first], starts[first] + n + LENGTH - 1)
    return row, starts[first] - offsets[row], n, grams[minimizer[first]], record


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``suffix_runs`` of whole rows in slices; a row over 8 MB in overlapping pieces."""
    for a, b in row_slices(offsets):
        part, edges = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        step = 8 << 20
        for low in range(0, max(1, len(part) - LENGTH + 1), step) if b == a + 1 else (0,):
            piece = part[low : low + step + LENGTH - 1] if b == a + 1 else part
            row, start, *rest = suffix_runs(piece, np.array([0, len(piece)]) if b == a + 1 else edges)
            yield row + a, start + low, *rest


SPANS = "k1 long, k2 long, low long, high long"
RUNS = "gram long, record long, k1 long, k2 long, start long, n long"


def _run_batch(gram, record, k1, k2, start, n) -> pa.RecordBatch:
    columns = (gram.view(np.int64), record.view(np.int64), k1, k2, start, n)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["gram", "record", "k1", "k2", "start", "n"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
        for row, start, n, gram, record in _pieces(data, offsets):
            yield _run_batch(gram, record, k1[row], k2[row], start, n)


def _split_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The listed runs, split by the longer minimizer."""
    for batch in batches:
        for k1, k2, text, runs in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "text", "runs")]):
            bodies = [text[r["start"] : r["start"] + r["n"] + LENGTH - 1] for r in runs]
            data = np.frombuffer(b"".join(bodies), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in bodies])])
            begin = np.array([r["start"] for r in runs])
            for a, b in row_slices(offsets):
                row, start, n, gram, record = suffix_runs(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], LONG_GRAM)
                yield _run_batch(gram, record, np.full(len(n), k1), np.full(len(n), k2), start + begin[row + a], n)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each listed run."""
    for batch in batches:
        out: list[list] = [[], [], [], [], [], []]
        size = 0
        for k1, k2, text, runs in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "text", "runs")]):
            for run in runs:
                start = run["start"]
                body = text[start : start + run["n"] + LENGTH - 1]
                for to, x in zip(out, (run["gram"], k1, k2, start, run["whole"], body)):
                    to.append(x)
                size += len(body)
            if size >= 4 << 20:
                yield _record_batch(out)
                out, size = [[], [], [], [], [], []], 0
        if out[0]:
            yield _record_batch(out)


def _record_batch(out: list[list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=["gram", "k1", "k2", "start", "whole", "body"])


def _span_batch(spans: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*spans) if spans else ([],) * 4)], names=["k1", "k2", "low", "high"])


def _block_spans(block: list[tuple]) -> list[tuple[int, int, int, int]]:
    """Repeated strings of whole buckets of (gram, body, k1, k2, start, whole).

    A record that is whole is known to be repeated and only compared with.
    """
    if not block:
        return []
    text = np.frombuffer(b"".join(record[1] for record in block), np.uint8)
    lengths = np.array([len(record[1]) for record in block])
    n = lengths - LENGTH + 1
    starts = ragged(np.cumsum(lengths) - lengths, n)
    number = {gram: k for k, gram in enumerate(dict.fromkeys(record[0] for record in block))}
    hit = repeated(text, starts, np.repeat([number[record[0]] for record in block], n))
    edges = np.cumsum(n) - n
    out = []
    for k in np.unique(np.repeat(np.arange(len(n)), n)[hit]):
        _, _, k1, k2, start, whole = block[k]
        if not whole:
            flags = np.diff(np.r_[0, hit[edges[k] : edges[k] + n[k]], 0].astype(np.int8))
            out += [(k1, k2, start + int(a), start + int(b) - 1 + LENGTH) for a, b in zip(np.flatnonzero(flags == 1), np.flatnonzero(flags == -1))]
    return out


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated strings; rows come sorted by gram, so buckets are consecutive."""
    block: list[tuple] = []
    size = 0
    for batch in batches:
        for record in zip(*[batch.column(c).to_pylist() for c in ("gram", "body", "k1", "k2", "start", "whole")]):
            if size >= BLOCK and record[0] != block[-1][0]:
                yield _span_batch(_block_spans(block))
                block, size = [], 0
            block.append(record)
            size += len(record[1])
    yield _span_batch(_block_spans(block))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A 128-bit hash of the bytes of every suffix of the listed runs."""
    other = _SecondHasher()
    for batch in batches:
        for k1, k2, text, runs in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "text", "runs")]):
            data = np.frombuffer(text, np.uint8)
            at = ragged(np.array([r["start"] for r in runs]), np.array([r["n"] for r in runs]))
            one, two = (h.ranges(h.prefix(data), at, at + LENGTH).view(np.int64) for h in (HASHER, other))
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), pa.array(np.full(len(at), k1)), pa.array(np.full(len(at), k2)), pa.array(at)], names=["h1", "h2", "k1", "k2", "start"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their merged spans."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for k1, k2, text, spans in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "text", "spans")]):
            merged: list[list[int]] = []
            for low, high in sorted((s["low"], s["high"]) for s in spans):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            kept, at = [], 0
            for low, high in merged:
                kept.append(text[at:low])
                at = high
            kept.append(text[at:])
            for to, x in zip(out, (k1, k2, [x for span in merged for x in span], sum(b - a for a, b in merged), b"".join(kept))):
                to.append(x)
        types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names=["k1", "k2", "removed", "n_removed", "kept"])


def text_keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _shared(runs: DataFrame) -> DataFrame:
    """The runs (saved) whose minimizer occurs elsewhere too: whole, first, variants added.

    whole: an equal record is elsewhere. first: the one of its equals that stands
    for them. variants: different records of the minimizer. Each small side is
    saved before its join, so that AQE may split a frequent minimizer's rows.
    """
    place = F.xxhash64("k1", "k2", "start")
    grams = runs.groupBy("gram").agg(F.min(place).alias("one"), F.max(place).alias("other")).where("one <> other").select("gram")
    shared = saved(runs.join(saved(grams, "grams"), "gram"), "shared-runs", compression="zstd")
    records = saved(shared.groupBy("gram", "record").agg(F.min(place).alias("one"), F.max(place).alias("other")), "records")
    variants = saved(records.groupBy("gram").agg(F.count("*").alias("variants")), "variants")
    marked = shared.join(records, ["gram", "record"]).join(variants, "gram")
    marked = marked.select("gram", "k1", "k2", "start", "n", (F.col("one") != F.col("other")).alias("whole"), (place == F.col("one")).alias("first"), "variants")
    return saved(marked, "marked-runs", compression="zstd")


def repeated_spans(docs: DataFrame, *, text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(k1, k2, removed, n_removed, kept) of each distinct text with something to remove.

    k1 and k2 are ``text_keys`` of the text; removed is flat, begin and end of each
    maximal run of removed bytes.
    """
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(*text_keys(text), text.cast("binary").alias("text")).where(F.length("text") >= LENGTH)
    runs = saved(texts.mapInArrow(_runs, RUNS), "suffix-runs", compression="zstd")
    # each copy of a text has a run at its start
    copied = runs.groupBy("k1", "k2").agg(F.count_if(F.col("start") == 0).alias("copies"), (F.max(F.col("start") + F.col("n")) + LENGTH - 1).alias("size")).where("copies > 1")
    copied = saved(copied, "copied-texts")
    marked = _shared(runs)

    def wanted(marked: DataFrame) -> DataFrame:
        """Of each text with a shared run, the runs whose bytes are needed."""
        run = F.struct("start", "n", "gram", "whole", (F.col("variants") > bucket).alias("large"))
        return marked.groupBy("k1", "k2").agg(F.collect_set(F.when(F.expr("first and variants > 1"), run)).alias("runs"))

    def some(found: DataFrame, large: bool) -> DataFrame:
        chosen = F.filter("runs", lambda run: run["large"] if large else ~run["large"])
        return found.select("k1", "k2", "text", chosen.alias("runs")).where(F.size("runs") > 0)

    def whole_spans(marked: DataFrame) -> DataFrame:
        return marked.where("whole").select("k1", "k2", F.col("start").alias("low"), (F.col("start") + F.col("n") + LENGTH - 1).alias("high"))

    def bucket_spans(found: DataFrame) -> DataFrame:
        records = some(found, large=False).mapInArrow(_records, "gram long, k1 long, k2 long, start long, whole boolean, body binary")
        return records.repartition("gram").sortWithinPartitions("gram").mapInArrow(_buckets, SPANS)

    # one row for each distinct text: copies meet map-side
    distinct = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    found = saved(distinct.join(wanted(marked), ["k1", "k2"]), "texts-with-runs", compression="zstd")
    spans = whole_spans(marked).unionByName(bucket_spans(found))
    large = some(found, large=True)
    if not large.isEmpty():
        marked = _shared(saved(large.mapInArrow(_split_runs, RUNS), "split-runs", compression="zstd"))
        again = saved(large.drop("runs").join(wanted(marked), ["k1", "k2"]), "split-texts", compression="zstd")
        hashes = some(again, large=True).mapInArrow(_hashes, "h1 long, h2 long, k1 long, k2 long, start long")
        repeats = hashes.groupBy("h1", "h2").agg(F.count("*").alias("times")).where("times > 1").drop("times")
        counted = hashes.join(repeats, ["h1", "h2"]).select("k1", "k2", F.col("start").alias("low"), (F.col("start") + LENGTH).alias("high"))
        spans = spans.unionByName(whole_spans(marked)).unionByName(bucket_spans(again)).unionByName(counted)
    by_text = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    single = by_text.join(copied, ["k1", "k2"], "left_anti")
    cut = found.select("k1", "k2", "text").join(single, ["k1", "k2"]).mapInArrow(_cut, "k1 long, k2 long, removed array<long>, n_removed long, kept binary")
    gone = copied.select("k1", "k2", F.array(F.lit(0).cast("long"), "size").alias("removed"), F.col("size").alias("n_removed"), F.lit(b"").alias("kept"))
    return cut.unionByName(gone)


def remove_repeats(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with kept (the remaining bytes), n_bytes, n_removed and n_spans."""
    new = ["kept", "n_bytes", "n_removed", "n_spans", "k1", "k2"]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    cut = repeated_spans(docs, text_col=text_col).select("k1", "k2", "n_removed", (F.size("removed") / 2).cast("long").alias("n_spans"), "kept")
    joined = base.select("*", *text_keys(text)).join(cut, ["k1", "k2"], "left")
    plain = [c for c in base.columns]
    return joined.select(
        *[F.col(f"`{c}`") for c in plain],
        F.coalesce("kept", text.cast("binary")).alias("kept"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
    )
