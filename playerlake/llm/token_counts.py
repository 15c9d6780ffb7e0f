"""Token counts by rank-synchronous merging.

Each Arrow slice is normalised, cut into pre-tokens where no piece can span, and
its distinct pre-tokens are merged together as ragged arrays
(``rank_merge.merge``); surviving symbols are counted back to the documents. The
counts are those of the sentencepiece library for the model, without begin or end
ids.

Defined results: null or empty text has 0 bytes and 0 tokens; repeated rows are
rows; other columns pass through, one named like a result is replaced by it;
malformed UTF-8 counts as replacement characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playerlake.llm.columns import bound_batches, ragged, row_slices, text_buffer
from playerlake.llm.piece_model import PieceModel, piece_model, read_model
from playerlake.llm.rank_merge import distinct_tokens, merge, pre_tokens

LIMIT = 4096


def valid_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buffer and offsets of well-formed UTF-8."""
    data, offsets = text_buffer(column)
    try:
        data.tobytes().decode("utf-8")
        return data, offsets
    except UnicodeDecodeError:
        rows = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
        return text_buffer(pa.array(rows, pa.large_string()))


def count_slice(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each text of a slice."""
    points, _, row_at = model.normalise(data, offsets)
    symbols, starts = pre_tokens(model, points, row_at)
    n_rows = len(offsets) - 1
    if not len(starts):
        return np.zeros(n_rows, np.int64)
    known = symbols[starts] >= 0  # a character without a symbol is a pre-token of its own
    tokens = np.zeros(len(starts), np.int64)
    alone = points[starts[~known]]
    tokens[~known] = 1 + (alone >= 0x80) + (alone >= 0x800) + (alone >= 0x10000)
    first, which = distinct_tokens(symbols, starts)
    lengths = np.diff(np.r_[starts, len(symbols)])
    usable = first[known[first]]
    out, n_out = merge(model, symbols[ragged(starts[usable], lengths[usable])], lengths[usable])
    counts = np.zeros(len(first), np.int64)
    ids = np.concatenate([[0], np.cumsum(model.symbol_n_ids[out])])
    ends = np.cumsum(n_out)
    counts[known[first]] = ids[ends] - ids[ends - n_out]
    tokens[known] = counts[which[known]]
    total = np.concatenate([[0], np.cumsum(tokens)])
    edge = np.searchsorted(starts, row_at)
    return total[edge[1:]] - total[edge[:-1]]


def count_tokens(docs: DataFrame, model_path: str, *, text_col: str = "text", limit: int = LIMIT, keep_text: bool = True) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit."""
    spark = docs.sparkSession
    bound_batches(spark)
    blob = spark.sparkContext.broadcast(read_model(model_path))
    results = ["n_bytes", "n_tokens", "over_limit"]
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in results])
    base = base.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    kept = [f for f in base.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType([*kept, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(blob.value)
        for batch in batches:
            sizes = np.diff(text_buffer(batch.column(text_col))[1])
            data, offsets = valid_text(batch.column(text_col))
            parts = [np.zeros(0, np.int64)]
            for a, b in row_slices(offsets):
                parts.append(count_slice(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
            n = np.concatenate(parts)
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes), pa.array(n), pa.array(n > limit)], names=schema.names)

    return base.mapInArrow(run, schema)
