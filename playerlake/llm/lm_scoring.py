"""Language-model scores from a log-bilinear model trained by noise contrast.

Vocabulary. Tasks encode shards of bounded size with a dictionary each; only the
dictionaries are shuffled, so every count is exact over the whole training corpus.
Counts are sums that Spark combines before the shuffle, and go back to the shards by
a join, of which adaptive execution can split a frequent word. The documents become
sequences of leaves.

Leaves. With V distinct training words a side is the cube root of V. The most
frequent words are symbols of their own; the others fall into about a side of
classes by their first and last bytes. The next side * side / 2 most frequent words
are leaves of their own in their class, the rest share half a side of groups a class.
So leaves grow with V ** (2/3), and what a token costs grows with the side.

Model. The next symbol's logit is bilinear in position-weighted embeddings of the
last ``CONTEXT`` leaves and an output embedding, plus a bias that starts at the
unigram; inside a class the same prediction meets the embeddings of the class's
leaves. Both levels train by noise-contrastive estimation, with noise from the symbols
and from the class, shared in a minibatch, over every training token once. There are
several rounds; in each the tasks train on a part of the documents, and Spark averages
every embedding, weighted by the tokens that have moved it. Scoring multiplies batches
of contexts with all outputs of a level, so each distribution is normalised exactly. A
word of a group then has its smoothed share of the group, one unseen word included,
and the whole is a distribution over the vocabulary and an unknown word.

Words: A-Z lower-cased, separated by space, tab to carriage return; an end token
follows each text. Word identity is a 64-bit hash of the spelling.

Defined results: null or empty text is the end token alone; a null doc_id counts
as the empty text for the split; repeated rows are rows and count each; words of
equal count take their places by their hash; a very long text is one row of its
shard and is scored whole; without training rows all scores follow from the
smoothing; an empty table gives no rows; extra columns are ignored. Ids are cast
to long, so other ids are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerlake.llm.columns import HASHER, LOWER, NOT_SPACE, bound_batches, row_slices, text_buffer, word_spans
from playerlake.llm.storage import saved

#: Most frequent words, which are symbols; and the least classes and groups a class.
WORDS = 160
MIN_CLASSES = 96
MIN_GROUPS = 8

WIDTH = 16
CONTEXT = 3
NOISE = 32
INNER_NOISE = 16
MINIBATCH = 4096
INNER_BATCH = 32768
SCORE_BATCH = 1024
RATE = 0.1
#: Documents are dealt over so many parts; a round trains on the parts below its limit that no round had before.
PARTS = 8
ROUNDS = (1, 3, 8)
#: Training tokens of a task, unless that leaves cores idle.
TASK_TOKENS = 32 << 20
SHARD_BYTES = 16 << 20
END_KEY = np.uint64(0x1)
SEED = 7

ENCODED = "kind int, shard long, doc_id long, held_out boolean, codes binary, key long, code int, class int, n long"


class _Shard:
    """Documents of a shard as codes of its own dictionary."""

    def __init__(self) -> None:
        self.ids: list = []
        self.held: list[bool] = []
        self.keys: list[np.ndarray] = []
        self.classes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, ids: list, held: list[bool], data: np.ndarray, offsets: np.ndarray) -> None:
        data = LOWER[data]
        starts, ends = word_spans(data, offsets, NOT_SPACE)
        hashes = HASHER.ranges(HASHER.prefix(data), starts, ends) | np.uint64(2)  # apart from the end's key
        # a word's class comes from its first two and last two bytes
        spelling = data.astype(np.uint64)
        mixed = ((spelling[starts] << np.uint64(24)) | (spelling[np.minimum(starts + 1, ends - 1)] << np.uint64(16)) | (spelling[np.maximum(ends - 2, starts)] << np.uint64(8)) | spelling[ends - 1]) * np.uint64(0x9E3779B97F4A7C15)
        classes = (mixed >> np.uint64(33)).astype(np.int32)  # modulo their number, once that is known
        row = np.searchsorted(offsets, starts, side="right") - 1
        n = np.bincount(row, minlength=len(offsets) - 1)
        place = np.arange(len(starts)) + row  # an end follows each row's words
        keys = np.full(len(starts) + len(n), END_KEY, np.uint64)
        keys[place] = hashes
        kinds = np.zeros(len(keys), np.int32)
        kinds[place] = classes
        self.ids += ids
        self.held += held
        self.keys.append(keys)
        self.classes.append(kinds)
        self.counts.append(n + 1)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        known, first, codes = np.unique(keys, return_index=True, return_inverse=True)
        held = np.array(self.held, bool)
        train = np.bincount(codes, weights=np.repeat(~held, counts), minlength=len(known)).astype(np.int64)
        names = [c.split()[0] for c in ENCODED.split(", ")]
        edges = np.concatenate([[0], np.cumsum(counts)])
        codes = codes.astype(np.int32)
        for low, high in row_slices(edges, 1 << 20):
            m = high - low
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * m, pa.int32()), pa.array([shard] * m, pa.int64()), pa.array(self.ids[low:high], pa.int64()), pa.array(held[low:high]),
                 pa.array([codes[edges[k] : edges[k + 1]].tobytes() for k in range(low, high)], pa.binary()),
                 pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64())], names=names)
        classes = np.concatenate(self.classes)[first]
        for low in range(0, len(known), 1 << 17):
            part = slice(low, low + (1 << 17))
            m = len(known[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), pa.array(np.full(m, shard, np.int64)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary()),
                 pa.array(known[part].view(np.int64)), pa.array(np.arange(low, low + m, dtype=np.int32)), pa.array(classes[part]), pa.array(train[part])], names=names)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, shard, size = TaskContext.get().partitionId() << 24, _Shard(), 0
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        ids, held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
        for a, b in row_slices(offsets):
            shard.add(ids[a:b], held[a:b], data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            size += int(offsets[b] - offsets[a])
            if size >= SHARD_BYTES:
                yield from shard.rows(number)
                number, shard, size = number + 1, _Shard(), 0
    if shard.ids:
        yield from shard.rows(number)


class Leaves:
    """Numbers of the leaves: symbols' words, then the groups by class, then the own leaves by class.

    ``row`` is a leaf's place among the leaves of classes in the order of classes, -1 for
    a symbol's word; class c has the rows from ``edges[c]`` to ``edges[c + 1]``.
    """

    def __init__(self, classes: int, groups: int, own: np.ndarray) -> None:
        self.classes, self.groups = classes, groups
        self.symbols = WORDS + classes
        kind = np.concatenate([np.repeat(np.arange(classes), groups), np.repeat(np.arange(classes), own)])
        self.size = WORDS + len(kind)
        self.symbol = np.concatenate([np.arange(WORDS), WORDS + kind]).astype(np.int32)
        self.row = np.full(self.size, -1, np.int32)
        order = np.argsort(kind, kind="stable")
        self.row[WORDS + order] = np.arange(len(kind))
        self.edges = np.concatenate([[0], np.cumsum(np.bincount(kind, minlength=classes))])
        self.shared = np.zeros(self.size, bool)
        self.shared[WORDS : WORDS + classes * groups] = True

    @staticmethod
    def sides(n_words: int) -> tuple[int, int, int]:
        """(classes, groups a class, words with an own leaf) for a vocabulary."""
        side = int(np.ceil(np.cbrt(n_words)))
        return max(MIN_CLASSES, side), max(MIN_GROUPS, side // 2), side * side // 2


def _sequences(leaves: Leaves, totals, n_tokens: int, n_words: int):
    """applyInArrow over a shard's dictionary and documents: sequences of leaves and count scores."""
    names = ["doc_id", "held_out", "part", "leaves", "n_tokens", "n_known", "base_score", "group_score"]

    def run(words: pa.Table, docs: pa.Table) -> pa.Table:
        size = words.num_rows
        code = words.column("code").to_numpy()
        leaf, count = np.zeros(size, np.int32), np.zeros(size, np.float64)
        leaf[code], count[code] = (words.column(c).to_numpy() for c in ("leaf", "count"))
        in_leaf, kinds = (t[leaf] for t in totals.value)
        base = np.log10((count + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
        share = np.where(leaves.shared[leaf], np.log10((count + 0.5) / (in_leaf + 0.5 * (kinds + 1))), 0.0)
        data, offsets = text_buffer(docs.column("codes"))
        codes, edges = data.view(np.int32) if len(data) else np.zeros(0, np.int32), offsets // 4
        n = np.diff(edges)
        sequence = leaf[codes].tobytes()
        sums = lambda x: np.add.reduceat(x[codes], edges[:-1]) if len(n) else np.zeros(0)  # noqa: E731  every document has its end token
        ids = docs.column("doc_id")
        part = np.array([hash(i) % PARTS if i is not None else 0 for i in ids.to_pylist()], np.int32)
        return pa.table([
            ids, docs.column("held_out"), pa.array(part), pa.array([sequence[a:b] for a, b in zip(offsets, offsets[1:])], pa.binary()), pa.array(n),
            pa.array(sums((count > 0).astype(np.int64)).astype(np.int64)), pa.array(sums(base)), pa.array(sums(share))], names=names)

    return run


class LogBilinear:
    """Embeddings of context leaves, weights of context places, outputs of symbols and of classes' leaves.

    The last column of a prediction is 1 and that of an output table its bias; inputs have none.
    ``seen`` has each row's mean of the squared gradients of former rounds, from which Adagrad goes on.
    """

    def __init__(self, leaves: Leaves, tables: list[np.ndarray], seen: list[np.ndarray] | None = None) -> None:
        self.leaves, self.tables = leaves, tables
        self.seen = [np.full(len(t), 1e-1, np.float32) for t in tables] if seen is None else seen
        self.inputs, self.places, self.outputs, self.inner = tables

    @classmethod
    def unigram(cls, leaves: Leaves, share: np.ndarray, inner_share: np.ndarray) -> LogBilinear:
        """Small random embeddings and the unigram's log-probabilities as biases."""
        rng = np.random.default_rng(SEED)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        biased = lambda p: np.column_stack([draw(len(p), WIDTH - 1), np.log(p).astype(np.float32)])
        return cls(leaves, [draw(leaves.size + 1, WIDTH), 1 + draw(CONTEXT, WIDTH), biased(share), biased(inner_share)])

    def copy(self) -> LogBilinear:
        return LogBilinear(self.leaves, [t.copy() for t in self.tables], [s.copy() for s in self.seen])

    def predict(self, context: np.ndarray) -> np.ndarray:
        """Predicted embedding of the next leaf from (rows, CONTEXT) leaves; its last column meets the biases."""
        out = self.inputs.take(context[:, 0], axis=0)
        out *= self.places[0]
        for j in range(1, CONTEXT):
            more = self.inputs.take(context[:, j], axis=0)
            more *= self.places[j]
            out += more
        out[:, -1] = 1
        return out

    def by_class(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """(positions of the targets in classes, sorted by row; their rows; (class, from, to) in these)."""
        row = self.leaves.row[target]
        at = np.flatnonzero(row >= 0)
        at = at[_order(row[at])]
        row = row[at]
        cuts = np.searchsorted(row, self.leaves.edges)
        return at, row, [(c, a, b) for c, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if b > a]

    def log10(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of each target leaf."""
        predicted = self.predict(context)
        logs = np.empty(len(target), np.float32)
        symbol = self.leaves.symbol[target]
        for low in range(0, len(target), SCORE_BATCH):
            part = slice(low, low + SCORE_BATCH)
            logs[part] = _log_softmax(predicted[part], self.outputs, symbol[part])
        at, row, runs = self.by_class(target)
        predicted = predicted[at]
        for c, a, b in runs:
            low, high = self.leaves.edges[c : c + 2]
            for start in range(a, b, SCORE_BATCH):
                part = slice(start, min(start + SCORE_BATCH, b))
                logs[at[part]] += _log_softmax(predicted[part], self.inner[low:high], row[part] - low)
        return logs / np.float32(np.log(10))


def _log_softmax(q: np.ndarray, outputs: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Logarithm of each row's share of its chosen output."""
    logits = q @ outputs.T
    picked = logits[np.arange(len(chosen)), chosen]
    # lengths bound the logits, and exponentials stay finite below 80; beyond that each row is moved by its largest one
    if np.einsum("ij,ij->i", q, q).max() * np.einsum("ij,ij->i", outputs, outputs).max() > 80**2:
        most = logits.max(axis=1)
        logits -= most[:, None]
        picked -= most
    np.exp(logits, out=logits)
    return picked - np.log(logits @ np.ones(len(outputs), np.float32))


def _order(index: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2 ** 32, by halves of 16 bits, which numpy sorts by radix."""
    order = np.argsort((index & 0xFFFF).astype(np.uint16), kind="stable")
    high = (index >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def _sum_rows(index: np.ndarray, values: np.ndarray, ordered: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct indices, the values' sums by them, their numbers)."""
    if not ordered:
        order = _order(index)
        index, values = index.take(order), values.take(order, axis=0)
    first = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    return index[first], np.add.reduceat(values, first, axis=0), np.diff(first, append=len(index))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)); the argument is overwritten."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """Noise-contrastive estimation with Adagrad steps on the rows that a minibatch touches.

    ``moved`` counts, for every row of every table, the tokens that have moved it.
    """

    INPUTS, PLACES, OUTPUTS, INNER = range(4)

    def __init__(self, model: LogBilinear, noise: np.ndarray, inner_noise: np.ndarray, seed: int) -> None:
        self.m, self.rng = model, np.random.default_rng([SEED, seed])
        self.noise_log = np.log(NOISE * noise).astype(np.float32)
        self.inner_log = np.log(INNER_NOISE * inner_noise).astype(np.float32)
        self.cumulative = np.cumsum(noise) / noise.sum()
        self.inner_cumulative = np.cumsum(inner_noise)
        self.seen = [np.repeat(s[:, None], WIDTH, axis=1) for s in model.seen]
        self.moved = [np.zeros(len(t), np.int64) for t in model.tables]
        self.tokens = 0

    def _climb(self, table: int, rows, gradient: np.ndarray, tokens) -> None:
        seen = self.seen[table].take(rows, axis=0) + gradient * gradient
        self.seen[table][rows] = seen
        t = self.m.tables[table]
        t[rows] = t.take(rows, axis=0) + np.float32(RATE) * gradient / np.sqrt(seen)
        self.moved[table][rows] += tokens

    def _back(self, context: np.ndarray, g_q: np.ndarray) -> None:
        """A step of the context's embeddings and the places' weights."""
        m, scale = self.m, np.float32(1 / np.sqrt(len(context)))
        g_q *= scale
        g_q[:, -1] = 0
        summed = [_sum_rows(context[:, j], g_q) for j in range(CONTEXT)]
        g_places = np.stack([np.einsum("ij,ij->j", m.inputs.take(rows, axis=0), sums) for rows, sums, _ in summed])
        for j, (rows, sums, n) in enumerate(summed):
            self._climb(self.INPUTS, rows, sums * m.places[j], n)
        self._climb(self.PLACES, np.arange(CONTEXT), g_places, len(context))

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        """One minibatch against noise from all symbols."""
        outputs = self.m.outputs
        target = self.m.leaves.symbol[target]
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), len(outputs) - 1)
        q, true_out, noise_out = self.m.predict(context), outputs.take(target, axis=0), outputs[drawn]
        # gradients of the log-likelihood of telling the true symbol from noise
        up = 1 - _sigmoid(np.einsum("ij,ij->i", q, true_out) - self.noise_log[target])
        down = -_sigmoid(q @ noise_out.T - self.noise_log[drawn])
        g_out = np.zeros_like(outputs)
        rows, sums, _ = _sum_rows(target, up[:, None] * q)
        g_out[rows] = sums
        np.add.at(g_out, drawn, down.T @ q)
        g_q = up[:, None] * true_out + down @ noise_out
        self._climb(self.OUTPUTS, np.arange(len(outputs)), g_out * np.float32(1 / np.sqrt(len(target))), len(target))
        self._back(context, g_q)
        self.tokens += len(target)

    def inner_step(self, context: np.ndarray, target: np.ndarray) -> None:
        """One minibatch in which each class's tokens meet noise from their class; it moves the outputs alone."""
        inner, edges = self.m.inner, self.m.leaves.edges
        at, row, runs = self.m.by_class(target)
        if not runs:
            return
        q, true_out = self.m.predict(context[at]), inner.take(row, axis=0)
        up = 1 - _sigmoid(np.einsum("ij,ij->i", q, true_out) - self.inner_log[row])
        rows, sums, _ = _sum_rows(row, up[:, None] * q, ordered=True)
        g_out, size = np.zeros_like(inner), np.ones(len(edges) - 1, np.float32)
        g_out[rows] = sums
        uniform = self.rng.random((len(edges) - 1, INNER_NOISE))
        ends = np.append(0.0, self.inner_cumulative)[edges]
        drawn = np.searchsorted(self.inner_cumulative, ends[:-1, None] + uniform * np.diff(ends)[:, None])
        drawn = np.clip(drawn, edges[:-1, None], edges[1:, None] - 1)
        for c, a, b in runs:
            part, noise_out = q[a:b], inner[drawn[c]]
            down = _sigmoid(part @ noise_out.T - self.inner_log[drawn[c]])
            np.subtract.at(g_out, drawn[c], down.T @ part)
            size[c] = b - a
        met = np.repeat(size, np.diff(edges))
        g_out /= np.sqrt(met)[:, None]
        rows = np.flatnonzero(g_out.any(axis=1))
        self._climb(self.INNER, rows, g_out[rows], met[rows].astype(np.int64))


def _contexts(batch: pa.RecordBatch, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """((tokens, CONTEXT) leaves before each token, nearest first; the tokens; row edges)."""
    data, offsets = text_buffer(batch.column("leaves"))
    data, offsets = data.view(np.int32), offsets // 4
    n = len(data)
    within = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    context = np.full((n, CONTEXT), start, np.int32)
    for j in range(CONTEXT):
        have = np.flatnonzero(within > j)
        context[have, j] = data[have - j - 1]
    return context, data, offsets


MOVED = f"part int, row int, moved long, seen float, {', '.join(f'v{k} float' for k in range(WIDTH))}"


def _train(model, noise, round_: int):
    """mapInArrow: trains over a task's sequences and gives each row that has moved."""
    names = [c.split()[0] for c in MOVED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # every round and task draws its own noise: the same draws again would teach the few drawn words alone
        trainer = Trainer(model.value.copy(), *noise.value, round_ << 32 | TaskContext.get().partitionId())
        start = trainer.m.leaves.size
        for batch in batches:
            context, target, _ = _contexts(batch, start)
            for low in range(0, len(target), INNER_BATCH):
                part = slice(low, low + INNER_BATCH)
                near, next_ = context[part], target[part]
                for k in trainer.rng.permutation(-(-len(next_) // MINIBATCH)):
                    trainer.step(near[k * MINIBATCH : (k + 1) * MINIBATCH], next_[k * MINIBATCH : (k + 1) * MINIBATCH])
                trainer.inner_step(near, next_)
        for table, moved in enumerate(trainer.moved):
            rows = np.flatnonzero(moved)
            values = trainer.m.tables[table][rows]
            for low in range(0, len(rows), 1 << 14):
                part = slice(low, low + (1 << 14))
                columns = [pa.array(np.full(len(rows[part]), table, np.int32)), pa.array(rows[part].astype(np.int32)), pa.array(moved[rows[part]]), pa.array(trainer.seen[table][rows[part]].mean(axis=1))]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(np.ascontiguousarray(v)) for v in values[part].T]], names=names)

    return run


def _averaged(model: LogBilinear, trained: DataFrame) -> LogBilinear:
    """The model with the means over tasks of the rows that any of them has moved."""
    means = [(F.sum(F.col(c) * F.col("moved")) / F.sum("moved")).cast("float").alias(c) for c in ("seen", *(f"v{k}" for k in range(WIDTH)))]
    rows = trained.groupBy("part", "row").agg(*means).toArrow()  # one for each row of the model
    out = model.copy()
    part, row, seen = (rows.column(c).to_numpy() for c in ("part", "row", "seen"))
    values = np.stack([rows.column(f"v{k}").to_numpy() for k in range(WIDTH)], axis=1)
    for table, t in enumerate(out.tables):
        t[row[part == table]] = values[part == table]
        out.seen[table][row[part == table]] = seen[part == table]
    return out


def _score(model):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            context, target, offsets = _contexts(batch, m.leaves.size)
            logs = np.empty(len(target), np.float64)
            for low in range(0, len(target), 4 * INNER_BATCH):
                part = slice(low, low + 4 * INNER_BATCH)
                logs[part] = m.log10(context[part], target[part])
            score = np.add.reduceat(logs, offsets[:-1]) + batch.column("group_score").to_numpy()
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names[:-1]], pa.array(score)], names=names)

    return run


def _placed(vocabulary: DataFrame, n_words: int) -> tuple[Leaves, DataFrame]:
    """(leaves, vocabulary with each word's leaf)."""
    spark = vocabulary.sparkSession
    classes, groups, n_own = Leaves.sides(n_words)
    seen = vocabulary.where("count > 0")
    top = seen.orderBy(F.desc("count"), "key").limit(WORDS + n_own).select("key", "class").toArrow()  # by V ** (2/3), as the model
    key, kind = top.column("key").to_numpy(), top.column("class").to_numpy()[WORDS:] % classes
    leaves = Leaves(classes, groups, np.bincount(kind, minlength=classes))
    leaf = np.arange(len(key), dtype=np.int32)
    leaf[WORDS:][np.argsort(kind, kind="stable")] = WORDS + classes * groups + np.arange(len(kind))
    own = spark.createDataFrame(pa.table([pa.array(key), pa.array(leaf)], names=["key", "own"]))
    group = F.lit(WORDS) + (F.col("class") % classes) * groups + F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int")
    return leaves, vocabulary.join(own, "key", "left").select("key", "count", F.coalesce("own", group).alias("leaf"))


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_out: F.Column | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``held_out`` says which rows the model does not learn from.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    share_out = spark.sparkContext.broadcast
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    held = F.coalesce(held_out if held_out is not None else F.crc32(name.cast("binary")) % 5 == 1, F.lit(False))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held.alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text"))
    encoded = saved(rows.mapInArrow(_encode, ENCODED), "lm-encoded", compression="zstd")

    words = encoded.where("kind = 1")
    vocabulary = saved(words.groupBy("key").agg(F.sum("n").alias("count"), F.min("class").alias("class")), "lm-vocabulary", compression="zstd")
    size = vocabulary.where("count > 0").agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    n_tokens, n_words = size["n"] or 0, size["v"]
    leaves, placed = _placed(vocabulary, n_words)
    found = placed.where("count > 0").groupBy("leaf").agg(F.sum("count").alias("n"), F.count("*").alias("v")).toArrow()  # a row a leaf
    totals = np.zeros((2, leaves.size))
    totals[:, found.column("leaf").to_numpy()] = found.column("n").to_numpy(), found.column("v").to_numpy()

    schema = "doc_id long, held_out boolean, part int, leaves binary, n_tokens long, n_known long, base_score double, group_score double"
    counted = words.select(F.col("shard").alias("of_shard"), "code", "key").join(placed, "key").select("of_shard", "code", "count", "leaf").groupBy("of_shard")
    coded = encoded.where("kind = 0").select("shard", "doc_id", "held_out", "codes").groupBy("shard")
    sequences = saved(counted.cogroup(coded).applyInArrow(_sequences(leaves, share_out(totals), n_tokens, n_words), schema), "lm-leaves", compression="zstd")

    share = np.bincount(leaves.symbol, weights=totals[0], minlength=leaves.symbols) + 0.5
    in_class = np.empty(leaves.size - WORDS)
    in_class[leaves.row[WORDS:]] = totals[0, WORDS:] + 0.5
    in_class /= np.repeat(np.add.reduceat(in_class, leaves.edges[:-1]), np.diff(leaves.edges))
    share /= share.sum()
    model, noise = LogBilinear.unigram(leaves, share, in_class), share_out((share, in_class))
    tasks = max(spark.sparkContext.defaultParallelism, n_tokens // TASK_TOKENS)
    for low, high in zip((0, *ROUNDS), ROUNDS):
        part = sequences.where(f"not held_out and part >= {low} and part < {high}").select("leaves").coalesce(tasks)
        model = _averaged(model, part.mapInArrow(_train(share_out(model), noise, low), MOVED))
    scored = sequences.mapInArrow(_score(share_out(model)), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long"))
