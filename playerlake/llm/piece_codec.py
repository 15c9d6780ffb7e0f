"""SentencePiece encoding with offsets, and decoding.

Normalisation replaces the longest prefix that the compiled character map knows
and records where every normalised character comes from. Pieces are the survivors
of rank-synchronous merging, and each is projected through that alignment to the
bytes of the original text. Ids are exactly those of the sentencepiece library,
without begin or end ids; decoding gives its decode(ids).

``piece_ends`` has the end of each piece as a byte offset of the text; a piece
begins where the one before ends, the first at 0. The inserted leading space and
all but the last of a character's byte pieces span nothing.

Defined results: null or empty text encodes to no ids and decodes to the empty
text; repeated rows are rows; other columns pass through, one named like a result
is replaced by it; malformed UTF-8 is read as replacement characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerlake.llm.columns import bound_batches, ragged, row_slices
from playerlake.llm.piece_model import PieceModel, piece_model, read_model
from playerlake.llm.rank_merge import distinct_tokens, merge, pre_tokens
from playerlake.llm.token_counts import valid_text


def encode_slice(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, byte end of each piece in its text, number of ids of each text)."""
    points, aligned, row_at = model.normalise(data, offsets)
    symbols, starts = pre_tokens(model, points, row_at)
    n_rows = len(offsets) - 1
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(n_rows, np.int64)
    lengths = np.diff(np.r_[starts, len(symbols)])
    known = symbols[starts] >= 0
    first, which = distinct_tokens(symbols, starts)
    # ids and widths of each distinct pre-token, in a pool
    usable = known[first]
    chosen = first[usable]
    out, n_out = merge(model, symbols[ragged(starts[chosen], lengths[chosen])], lengths[chosen])
    at = ragged(model.symbol_first_id[out], model.symbol_n_ids[out])
    pool_ids, pool_widths = model.symbol_ids[at], model.symbol_widths[at]
    upto = np.concatenate([[0], np.cumsum(model.symbol_n_ids[out])])
    ends = np.cumsum(n_out)
    size, place = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
    size[usable], place[usable] = upto[ends] - upto[ends - n_out], upto[ends - n_out]
    # characters without a symbol: their bytes
    alone = np.flatnonzero(~known)
    if len(alone):
        spelled = [chr(p).encode() for p in points[starts[alone]].tolist()]
        extra = np.frombuffer(b"".join(spelled), np.uint8)
        n_extra = np.array([len(s) for s in spelled], np.int64)
        widths = np.zeros(len(extra), np.int32)
        widths[np.cumsum(n_extra) - 1] = 1
        token_size, token_place = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        token_size[known], token_place[known] = size[which[known]], place[which[known]]
        token_size[alone], token_place[alone] = n_extra, len(pool_ids) + np.cumsum(n_extra) - n_extra
        pool_ids, pool_widths = np.r_[pool_ids, model.byte_ids[extra]], np.r_[pool_widths, widths]
    else:
        token_size, token_place = size[which], place[which]
    take = ragged(token_place, token_size)
    ids = pool_ids[take]
    total = np.concatenate([[0], np.cumsum(token_size)])
    edge = total[np.searchsorted(starts, row_at)]
    n_ids = edge[1:] - edge[:-1]
    row = np.repeat(np.arange(n_rows), n_ids)
    piece_end = np.cumsum(pool_widths[take])  # in characters of all rows
    ends = aligned[piece_end + row] - offsets[row]
    return ids, ends.astype(np.int32), n_ids


def decode_slice(model: PieceModel, ids: np.ndarray, n_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, length of each text) of id sequences; a leading space that encoding inserted is dropped."""
    row_at = np.cumsum(n_ids) - n_ids
    begin, size = model.id_at[ids].copy(), model.id_size[ids].copy()
    some = np.flatnonzero(n_ids)
    if model.dummy_prefix and len(some):
        head = row_at[some]
        head = head[model.id_has_space[ids[head]]]
        begin[head] += 1
        size[head] -= 1
    data = model.id_bytes[ragged(begin, size)]
    total = np.concatenate([[0], np.cumsum(size)])
    return data, total[row_at + n_ids] - total[row_at]


def _strings(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    sizes = np.concatenate([np.zeros(1, np.int64), *[s for _, s in parts]])
    data = b"".join(d.tobytes() for d, _ in parts)
    text = pa.Array.from_buffers(pa.large_binary(), len(sizes) - 1, [None, pa.py_buffer(np.cumsum(sizes)), pa.py_buffer(data)])
    try:
        return text.cast(pa.string())
    except pa.ArrowInvalid:  # byte pieces that are no character: the library gives replacement characters
        return pa.array([b.decode("utf-8", "replace") for b in text.to_pylist()], pa.string())


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, pa.int32()))


def encode(docs: DataFrame, model_path: str, *, text_col: str = "text", decoded: bool = False, keep_text: bool = True) -> DataFrame:
    """``docs`` with ids and piece_ends, and with ``decoded`` the text decoded from the ids."""
    spark = docs.sparkSession
    bound_batches(spark)
    blob = spark.sparkContext.broadcast(read_model(model_path))
    new = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("piece_ends", T.ArrayType(T.IntegerType()))]
    new += [T.StructField("decoded", T.StringType())] * decoded
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in {f.name for f in new}])
    base = base.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    kept = [f for f in base.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType([*kept, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(blob.value)
        for batch in batches:
            data, offsets = valid_text(batch.column(text_col))
            parts = []
            for a, b in row_slices(offsets):
                parts.append(encode_slice(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
            counts = np.concatenate([np.zeros(0, np.int64), *[n for _, _, n in parts]])
            ids, ends = (np.concatenate([np.zeros(0, np.int32), *[p[k] for p in parts]]) for k in (0, 1))
            columns = [batch.column(f.name) for f in kept] + [_lists(counts, ids), _lists(counts, ends)]
            if decoded:
                columns.append(_strings([decode_slice(model, i, n) for i, _, n in parts]))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return base.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, *, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``; null ids decode to the empty text."""
    spark = encoded.sparkSession
    bound_batches(spark)
    blob = spark.sparkContext.broadcast(read_model(model_path))
    base = encoded.select(*[F.col(f"`{c}`") for c in encoded.columns if c.lower() != "decoded"])
    base = base.withColumn(ids_col, F.col(f"`{ids_col}`").cast("array<int>"))
    schema = T.StructType([*base.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(blob.value)
        for batch in batches:
            lists = batch.column(ids_col)
            counts = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, _strings([decode_slice(model, ids, counts)])], names=schema.names)

    return base.mapInArrow(run, schema)
