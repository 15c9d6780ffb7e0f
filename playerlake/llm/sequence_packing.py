"""Packing of documents into training sequences, certified by lower bounds.

Texts become ids (``word_ids``), each document followed by an end id, and documents
longer than a sequence are cut. Pieces that fill a sequence are one. The others are
dealt into groups of bounded size, and each group packs its pieces by best-fit
decreasing. A lower bound from dual feasible functions certifies its number of
sequences. What a group uses beyond its bound is its gap: it gives the pieces of its
emptiest sequences away, as many sequences as hold the gap's room and one sequence's
more. All given pieces are dealt into fewer, mixed groups and packed again; the new
packing stands if it has fewer sequences. Where a round gains little, the next one
takes sequences with four times the room, up to ``WIDEST``. The rounds end there, or
when the number of sequences is the lower bound of the whole corpus, which comes from
a histogram of lengths. Each round takes from bounded groups and leaves the rest as
it was written.

Defined results: null or empty text is the end id alone; very long texts are cut into
as many pieces as they need; repeated rows are documents of their own, with equal
lengths and any places; documents of equal length are taken in the order of their
rows; without rows the result is empty; other columns pass through, one named like a
result is replaced by it; malformed UTF-8 counts as replacement characters.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerlake.llm.best_fit import best_fit_decreasing, lower_bound
from playerlake.llm.columns import bound_batches, row_slices
from playerlake.llm.piece_model import read_model
from playerlake.llm.storage import saved
from playerlake.llm.token_counts import valid_text
from playerlake.llm.word_ids import word_encoder

CAPACITY = 2048
END_ID = 0

#: Pieces of a group: what one task holds and packs at a time.
GROUP = 8192

#: The last exchange takes sequences with 4 to this power times the room of the first.
WIDEST = 3
SLICE = 4 << 20

PIECE = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
PLACE = [("sequence_id", T.LongType()), ("offset", T.LongType()), ("certified", T.BooleanType())]
_ROW = "__row"


def cut_documents(docs: DataFrame, tokenizer_path: str, *, text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """One row for each piece: the document's other columns, piece, start, length, ids_crc32 (and ids)."""
    spark = docs.sparkSession
    bound_batches(spark)
    blob = spark.sparkContext.broadcast(read_model(tokenizer_path))
    results = [name for name, _ in PIECE + PLACE] + ["ids", _ROW]
    others = [c for c in docs.columns if c != text_col and c.lower() not in results]
    base = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text_col}`").cast("string").alias("__text"))
    new = PIECE + [("ids", T.ArrayType(T.IntegerType()))] * keep_ids
    schema = T.StructType([*base.schema.fields[:-1], *[T.StructField(name, kind) for name, kind in new]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(blob.value)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            data, offsets = valid_text(batch.column(len(others)))
            for a, b in row_slices(offsets, SLICE):
                ids, edges = encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                row, piece, start, length, crc, bodies = [], [], [], [], [], []
                for k, (low, high) in enumerate(zip(edges.tolist(), edges[1:].tolist()), a):
                    body = ids[low:high].tobytes() + end
                    for at in range(0, len(body), 4 * capacity):
                        part = body[at : at + 4 * capacity]
                        for to, x in zip((row, piece, start, length, crc), (k, at // (4 * capacity), at // 4, len(part) // 4, zlib.crc32(part))):
                            to.append(x)
                        if keep_ids:
                            bodies.append(np.frombuffer(part, "<u4"))
                kept = [batch.column(k).take(pa.array(row, pa.int64())) for k in range(len(others))]
                kept += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                kept += [pa.array(bodies, pa.list_(pa.int32()))] * keep_ids
                yield pa.RecordBatch.from_arrays(kept, names=schema.names)

    return base.mapInArrow(run, schema)


def _pack_group(capacity: int):
    """A group's pieces with sequence, offset and the width of exchange from which its sequence is given (-1: none)."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by(_ROW)
        length, row = table.column("length").to_numpy(), table.column(_ROW).to_numpy()
        bins, offsets, n_bins = best_fit_decreasing(length, capacity)
        bound = lower_bound(*np.unique(length, return_counts=True), capacity)
        names = np.zeros(n_bins, np.int64)
        names[bins[offsets == 0]] = row[offsets == 0]  # a sequence is named by its first piece
        room = capacity - np.bincount(bins, length, n_bins).astype(np.int64)
        emptiest = np.argsort(-room, kind="stable")
        width = np.full(n_bins, -1, np.int32)
        if (gap := n_bins - bound) > 0:
            before = np.cumsum(room[emptiest]) - room[emptiest]
            first = int(gap * capacity) + capacity
            width[emptiest] = np.searchsorted(first * 4 ** np.arange(WIDEST + 1), before, side="right")
        new = [names[bins], offsets, np.full(len(row), n_bins == ceil(bound)), width[bins]]
        for name, column in zip([*[name for name, _ in PLACE], "width"], new):
            table = table.append_column(name, pa.array(column))
        return table.drop_columns("part")

    return pack


def _packed(pieces: DataFrame, n: int, capacity: int, group: int, turn: int) -> DataFrame:
    """``pieces`` dealt into groups and packed, saved."""
    groups = max(1, -(-n // group))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64(_ROW, F.lit(turn)), F.lit(groups)))
    schema = T.StructType([*pieces.schema.fields, *[T.StructField(name, kind) for name, kind in PLACE], T.StructField("width", T.IntegerType())])
    return saved(dealt.groupBy("part").applyInArrow(_pack_group(capacity), schema), "packed-pieces")


def _sequences(placed: DataFrame) -> tuple[int, int]:
    """(pieces, sequences): each sequence has one piece at offset 0."""
    found = placed.agg(F.count("*").alias("n"), F.count_if(F.col("offset") == 0).alias("bins")).collect()[0]
    return found.n, found.bins


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def pack_pieces(pieces: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` (with length) and sequence_id, offset, certified.

    certified: the piece's sequence comes from a group whose number of sequences is
    its lower bound, or it fills its sequence.
    """
    kept = [c for c in pieces.columns if c.lower() not in [name for name, _ in PLACE]]
    pieces = saved(pieces.select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias(_ROW)), "pieces")
    full = pieces.where(F.col("length") >= capacity)
    done = [full.select("*", F.col(_ROW).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))]
    rest = pieces.where(F.col("length") < capacity)
    # at most one row for each length
    lengths = rest.groupBy("length").count().collect()
    least = ceil(lower_bound(np.array([r["length"] for r in lengths]), np.array([r["count"] for r in lengths]), capacity))
    n = sum(r["count"] for r in lengths)
    placed, turn, width = [_packed(rest, n, capacity, group, 0)], 0, 0
    total = _sequences(placed[0])[1] if n > group else least
    while total > least and width <= WIDEST:
        given = _union([part.where(F.col("width").between(0, width)) for part in placed])
        n, before = _sequences(given)
        turn += 1
        again = _packed(given.drop(*[name for name, _ in PLACE], "width"), n, capacity, group, turn)
        gain = before - _sequences(again)[1]
        if gain > 0:
            placed = [part.where(~F.col("width").between(0, width)) for part in placed] + [again]
        if 10 * gain < total - least:
            width += 1
        total -= max(gain, 0)
    return _union([*done, *[part.drop("width") for part in placed]]).drop(_ROW)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP, keep_ids: bool = True) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most ``capacity`` ids."""
    return pack_pieces(cut_documents(docs, tokenizer_path, text_col=text_col, capacity=capacity, end_id=end_id, keep_ids=keep_ids), capacity=capacity, group=group)


def least_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> Fraction:
    """Lower bound of the number of sequences of the given pieces."""
    lengths = pieces.groupBy("length").count().collect()
    return lower_bound(np.array([r["length"] for r in lengths]), np.array([r["count"] for r in lengths]), capacity)
