"""Quality classifier on pooled random-indexing vectors.

Every word is two units: its spelling, and its frame (the runs of upper case,
lower case and digits with its punctuation). Units hash to a fixed number of
rows. Random indexing gives each unit a sparse ternary index vector and sums the
index vectors of the neighbours of all its occurrences, over all documents; the
sums are integers, so they merge exactly in any order. A document pools the
vectors of its units to their mean and spread. A two-layer numpy network learns
from a bounded sample of labelled rows, and a temperature fitted on a part of the
sample that it did not train on calibrates its probabilities.

Only the text is an input. Defined results: null or empty text pools to zeros and
is scored like any other; repeated rows are rows; a labelled id that occurs
several times trains with each of its rows; labels that are null are ignored;
with fewer than two classes to learn from the score is the smoothed share of
label 1; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerlake.llm.columns import HASHER, LOWER, NOT_SPACE, bound_batches, row_slices, text_buffer, word_spans
from playerlake.llm.storage import saved

UNITS = 1 << 13  # rows of each of the two kinds of units
WIDTH = 32
NONZERO = 4
REACH = 2
HIDDEN = 32
EPOCHS = 60
MINIBATCH = 256
RATE = 0.003
DECAY = 1e-4
#: Labelled rows that the network is fitted on, the smallest by a hash of their id.
TRAIN_ROWS = 20_000
CUTOFF = 0.3
SEED = 11

FEATURES = 4 * WIDTH + 2

#: Character classes of a frame: upper case, lower case (and all above ASCII), digits, others as they are.
FRAME = np.arange(256, dtype=np.uint8)
FRAME[0x41:0x5B], FRAME[0x61:0x7B], FRAME[0x30:0x3A] = ord("X"), ord("x"), ord("9")
FRAME[0x80:] = ord("x")


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors of all units, the same on every task."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((2 * UNITS, WIDTH), np.int8)
    for k in range(NONZERO):
        out[np.arange(2 * UNITS), rng.integers(0, WIDTH, 2 * UNITS)] = rng.choice([-1, 1], 2 * UNITS) if k else 1
    return out


def units_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(spelling unit, frame unit, row) of every word."""
    starts, ends = word_spans(data, offsets, NOT_SPACE)
    spelling = HASHER.ranges(HASHER.prefix(LOWER[data]), starts, ends)
    # frames: the first byte of each run of a class inside a word
    frame = FRAME[data]
    kept = np.ones(len(data), bool)
    kept[1:] = frame[1:] != frame[:-1]
    kept[starts] = True
    upto = np.concatenate([[0], np.cumsum(kept)])
    frames = HASHER.ranges(HASHER.prefix(frame[kept]), upto[starts], upto[ends])
    shift = np.uint64(64 - UNITS.bit_length() + 1)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return (spelling >> shift).astype(np.int64), UNITS + (frames >> shift).astype(np.int64), row


def _sums_by(index: np.ndarray, values: np.ndarray, out: np.ndarray) -> None:
    """Add the columns of ``values`` (WIDTH, words) to the columns of ``out`` that index names."""
    if len(index):
        order = np.argsort(index.astype(np.int16), kind="stable")
        ordered = index[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        out[:, ordered[first]] += np.add.reduceat(values[:, order], first, axis=1, dtype=np.int32)


def _accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Context sums of all units that a task saw. One row a dimension: sums run along memory."""
    index = np.ascontiguousarray(index_vectors().T)
    sums, seen = np.zeros((WIDTH, 2 * UNITS), np.int64), np.zeros(2 * UNITS, np.int64)
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for a, b in row_slices(offsets):
            word, frame, row = units_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            own = np.take(index, word, axis=1) + np.take(index, frame, axis=1)
            near = np.zeros_like(own)  # entries of at most 2 * 2 * REACH: a byte holds them
            for step in range(1, REACH + 1):
                near[:, step:] += own[:, :-step]
                near[:, :-step] += own[:, step:]
                # words of two texts are no neighbours
                apart = np.flatnonzero(row[step:] != row[:-step])
                near[:, apart + step] -= own[:, apart]
                near[:, apart] -= own[:, apart + step]
            _sums_by(word, near, sums)
            _sums_by(frame, near, sums)
            seen += np.bincount(word, minlength=2 * UNITS) + np.bincount(frame, minlength=2 * UNITS)
    have = np.flatnonzero(seen)
    names = ["unit", "seen", *[f"v{k}" for k in range(WIDTH)]]
    yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(seen[have]), *[pa.array(sums[k, have]) for k in range(WIDTH)]], names=names)


def unit_vectors(texts: DataFrame) -> np.ndarray:
    """(2 UNITS, WIDTH) word vectors: unit length, less their mean. The driver gets one row a unit."""
    schema = "unit long, seen long, " + ", ".join(f"v{k} long" for k in range(WIDTH))
    rows = texts.select("text").mapInArrow(_accumulate, schema).groupBy("unit").agg(F.sum("seen").alias("seen"), *[F.sum(f"v{k}").alias(f"v{k}") for k in range(WIDTH)])
    table = rows.toArrow()
    out, weight = np.zeros((2 * UNITS, WIDTH)), np.zeros(2 * UNITS)
    unit = table.column("unit").to_numpy()
    weight[unit] = table.column("seen").to_numpy()
    for k in range(WIDTH):
        out[unit, k] = table.column(f"v{k}").to_numpy()
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    if weight.sum():
        out[unit] -= (out * weight[:, None]).sum(axis=0) / weight.sum()
    return np.asfortranarray(out.astype(np.float32))  # a dimension's values lie together


def pool(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """(rows, FEATURES): mean and spread of both kinds of units, and two measures of length."""
    word, frame, row = units_of(data, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1)
    out = np.zeros((len(n), FEATURES), np.float32)
    have = np.flatnonzero(n)
    if len(have):
        first = (np.cumsum(n) - n)[have]
        count = n[have].astype(np.float32)
        for k, unit in enumerate((word, frame)):
            v = np.take(vectors.T, unit, axis=1)
            mean = np.add.reduceat(v, first, axis=1) / count
            square = np.add.reduceat(v * v, first, axis=1) / count
            out[have, 2 * k * WIDTH : (2 * k + 1) * WIDTH] = mean.T
            out[have, (2 * k + 1) * WIDTH : (2 * k + 2) * WIDTH] = np.sqrt(np.maximum(square - mean * mean, 0)).T
    out[:, -2] = np.log1p(n)
    out[:, -1] = np.log1p(np.diff(offsets)) - np.log1p(n)
    return out


def _pooled(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            parts = [np.zeros((0, FEATURES), np.float32)]
            for a, b in row_slices(offsets):
                parts.append(pool(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], vectors.value))
            flat = np.concatenate(parts).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, FEATURES, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), lists], names=["doc_id", "held_out", "features"])

    return run


class Network:
    """Two layers, tanh between them, one logit, and a temperature."""

    def __init__(self, centre, scale, w1, b1, w2, b2, temperature=1.0) -> None:
        self.centre, self.scale, self.w1, self.b1, self.w2, self.b2, self.temperature = centre, scale, w1, b1, w2, b2, temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))

    @classmethod
    def constant(cls, share: float) -> Network:
        return cls(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the log loss; a fifth of the rows is kept for the temperature."""
    if len(np.unique(y)) < 2:
        return Network.constant((y.sum() + 1) / (len(y) + 2))
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    cut = max(1, len(y) // 5)
    calibrate, train = order[:cut], order[cut:]
    if len(np.unique(y[train])) < 2:
        train = order
    centre, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
    net = Network(centre, scale, rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1))
    x0, y0 = (x[train] - centre) / scale, y[train].astype(np.float64)
    weights = [net.w1, net.b1, net.w2, net.b2]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        mixed = rng.permutation(len(y0))
        for low in range(0, len(y0), MINIBATCH):
            at = mixed[low : low + MINIBATCH]
            xb, yb = x0[at], y0[at]
            hidden = np.tanh(xb @ net.w1 + net.b1)
            p = 1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -60, 60)))
            error = (p - yb) / len(at)
            back = error[:, None] * net.w2 * (1 - hidden * hidden)
            grads = [xb.T @ back + DECAY * net.w1, back.sum(axis=0), hidden.T @ error + DECAY * net.w2, np.array([error.sum()])]
            step += 1
            for w, g, a, b in zip(weights, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    logits, truth = net.logits(x[calibrate]), y[calibrate]
    loss = lambda t: np.logaddexp(0, np.where(truth > 0, -1, 1) * logits / t).mean()
    net.temperature = float(min(np.geomspace(0.5, 20, 80), key=loss))
    return net


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", held_out: Column | None = None, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    spark = docs.sparkSession
    bound_batches(spark)

    def apart(id_: Column) -> Column:
        return F.coalesce(held_out if held_out is not None else F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))

    id_ = F.col(f"`{id_col}`")
    texts = docs.select(id_.cast("long").alias("doc_id"), apart(id_).alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text"))
    vectors = spark.sparkContext.broadcast(unit_vectors(texts))  # UNITS rows, whatever the corpus
    pooled = saved(texts.mapInArrow(_pooled(vectors), "doc_id long, held_out boolean, features array<float>"), "pooled")

    known = labels.where(F.col(f"`{label_col}`").isNotNull() & ~apart(id_)).select(id_.cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(train_rows)
    rows = pooled.join(sample, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).select("features", "label").toArrow()
    x = np.array(rows.column("features").combine_chunks().flatten() if rows.num_rows else [], np.float64).reshape(-1, FEATURES)
    network = spark.sparkContext.broadcast(fit(x, rows.column("label").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(-1, FEATURES)
            p = np.broadcast_to(network.value.probability(x), len(x))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p, pa.float64()), pa.array((p >= CUTOFF).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return pooled.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
