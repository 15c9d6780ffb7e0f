"""SimHash near-duplicate groups by bit-sliced comparison.

A fingerprint bit is set where over half of the shingle hashes (XXH64, seed 42)
have it. Equal fingerprints collapse first, so exact copies and empty texts cost
one row. Two fingerprints that differ in at most ``radius`` bits agree on the bits
of some choice of blocks (``block_choices``). Rows that share these bits form a
bucket, in which they are compared bit-sliced. A bucket emits a spanning forest of
its links, never all pairs. Buckets over ``TILE`` rows are cut into tiles, and every
pair of tiles meets in some task.

Words: A-Z lower-cased, separated by space, tab to carriage return.

Defined results: null or empty text has no shingle and fingerprint zero, linked
like any other; fewer words than a shingle are one shingle; rows that repeat a
doc_id keep a row each; a null doc_id is grouped like any other and never the
component's name unless its group has no other id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from playerlake.llm.bit_slices import close_pairs
from playerlake.llm.columns import LOWER, NOT_SPACE, bound_batches, ragged, row_slices, text_buffer, word_spans
from playerlake.llm.components import components
from playerlake.llm.storage import saved

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
TILE = 8192
SEED = 42

#: Byte k of SPREAD[b] is bit k of b: eight counters in one word.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]


def _shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle, and the number of shingles of each row."""
    starts, ends = word_spans(data, offsets, NOT_SPACE)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(rows, minlength=len(offsets) - 1)
    lengths = ends - starts
    # words of all rows, each followed by one space
    at = ragged(starts, lengths)
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    text[ragged(begin, lengths)] = LOWER[data[at]]
    n = np.where(n_words >= width, n_words - width + 1, (n_words > 0).astype(np.int64))
    first = ragged(np.cumsum(n_words) - n_words, n)
    last = first + np.repeat(np.minimum(n_words, width), n) - 1
    joined = text.tobytes()
    low, high = begin[first].tolist(), (begin[last] + lengths[last]).tolist()
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(low, high)), np.uint64, len(low))
    return hashes, n


def _set_bits(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per row, the bits set in over half of its hashes."""
    out = np.zeros(len(n), np.uint64)
    if not len(hashes):
        return out
    # byte counters of at most 255 hashes, then sums of those
    pieces = -(-n // 255)
    length = np.minimum(255, np.repeat(n, pieces) - 255 * ragged(np.zeros(len(n), np.int64), pieces))
    piece_at = np.cumsum(length) - length
    have = np.flatnonzero(n)
    row_at = (np.cumsum(pieces) - pieces)[have]
    octets = hashes.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        packed = np.add.reduceat(SPREAD[octets[:, byte]], piece_at)
        counts = np.add.reduceat(packed.view(np.uint8).reshape(-1, 8).astype(np.int64), row_at, axis=0)
        over = (2 * counts > n[have, None]).astype(np.uint64)
        out[have] |= (over << (np.arange(8, dtype=np.uint64) + np.uint64(8 * byte))).sum(axis=1, dtype=np.uint64)
    return out


def row_keys(id_: Column, text: Column) -> list[Column]:
    """A 128-bit hash of id and text: rows that share it are equal in both."""
    id_, text = F.coalesce(id_.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))
    return [F.xxhash64(id_, text).alias("r1"), F.xxhash64(F.lit(1), id_, text).alias("r2")]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, r1, r2, fp): the 64-bit fingerprint of each row as a signed long, and the ``row_keys``."""
    bound_batches(docs.sparkSession)
    id_, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    rows = docs.select(id_.alias("id"), *row_keys(id_, text), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            parts = [np.zeros(0, np.uint64)]
            for a, b in row_slices(offsets):
                parts.append(_set_bits(*_shingle_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shingle)))
            keys = [batch.column(c) for c in ("id", "r1", "r2")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(np.concatenate(parts).view(np.int64))], names=["id", "r1", "r2", "fp"])

    return rows.mapInArrow(run, "id long, r1 long, r2 long, fp long")


def block_choices(radius: int, blocks: int = BLOCKS) -> list[int]:
    """Bit masks one of which two fingerprints within the radius agree on.

    64 bits in ``blocks`` blocks: ``radius`` differing bits touch at most
    ``radius`` of them, so some choice of ``blocks - radius`` blocks is untouched.
    """
    if blocks <= radius:
        raise ValueError("more blocks than differing bits are needed")
    edges = [round(k * 64 / blocks) for k in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(masks, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(i: np.ndarray, j: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Positions of pairs that join trees; ``root`` (row to root row) is brought up to date."""
    kept = []
    live = np.arange(len(i))
    while len(live):
        x, y = root[i[live]], root[j[live]]
        apart = x != y
        live, high, low = live[apart], np.maximum(x, y)[apart], np.minimum(x, y)[apart]
        # each root takes one link to a smaller root, so no cycle can form
        by = np.lexsort((low, high))
        first = by[np.r_[True, high[by][1:] != high[by][:-1]]] if len(by) else by
        root[high[first]] = low[first]
        kept.append(live[first])
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up
    return np.concatenate(kept) if kept else live


def _bucket_edges(keys: np.ndarray) -> np.ndarray:
    return np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]


def _compare(bucket: np.ndarray, fp: np.ndarray, node: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """Spanning links inside whole buckets."""
    edges = _bucket_edges(bucket)
    end = np.repeat(edges[1:], np.diff(edges))
    shared = end - np.repeat(edges[:-1], np.diff(edges)) > 1
    if not shared.any():
        return
    fp, node, end = fp[shared], node[shared], np.cumsum(shared)[end - 1][shared]
    root = np.arange(len(fp))
    for i, j in close_pairs(fp.view(np.uint64), end, radius):
        keep = _forest(i, j, root)
        yield pa.RecordBatch.from_arrays([pa.array(node[i[keep]]), pa.array(node[j[keep]])], names=["a", "b"])


def _links(radius: int):
    """mapInArrow over rows sorted by bucket: (a, b) node pairs within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            now = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("bucket", "fp", "node"))]
            cut = int(_bucket_edges(now[0])[-2])  # the last bucket may go on
            if cut:
                yield from _compare(*[x[:cut] for x in now], radius)
            held = [x[cut:] for x in now]
        if len(held[0]):
            yield from _compare(*held, radius)

    return run


def near_links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Spanning links (a, b) of nodes (node, fp) with distinct fingerprints within the radius."""
    masks = block_choices(radius, blocks)
    table = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("choice", "bits")
    rows = nodes.select("node", "fp", table).select("node", "fp", F.xxhash64("choice", "bits").alias("bucket"))
    # a bucket over the tile size is cut into chunks by fingerprint hash; each pair of chunks is a bucket of its own
    large = rows.groupBy("bucket").count().where(F.col("count") > tile)
    large = large.select("bucket", F.ceil(F.col("count") * 2 / tile).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.xxhash64("bucket", F.least(k, F.col("chunk")), F.greatest(k, F.col("chunk"))))
    rows = rows.join(large, "bucket", "left").withColumn("chunk", chunk)
    rows = rows.select("node", "fp", F.explode(F.when(F.col("chunks").isNull(), F.array("bucket")).otherwise(pairs)).alias("bucket"))
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "fp")
    return rows.mapInArrow(_links(radius), "a long, b long").distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """(id, r1, r2, fp, group) of every row; group is the smallest fingerprint of the rows linked to it."""
    prints = saved(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "fingerprints")
    nodes = saved(prints.select(F.col("fp").alias("node"), "fp").distinct(), "nodes")
    groups = components(near_links(nodes, radius)).select(F.col("node").alias("fp"), F.col("component").alias("group"))
    # saved before the join: a frequent fingerprint's rows may then be split
    return prints.join(saved(groups, "groups"), "fp", "left").select("id", "r1", "r2", "fp", F.coalesce("group", "fp").alias("group"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id, fp, component) of every row; component is the smallest id of its group."""
    rows = _grouped(docs, id_col, text_col, shingle, radius)
    names = rows.groupBy("group").agg(F.min("id").alias("component"))
    return rows.join(saved(names, "group-names"), "group").select("id", "fp", "component")


def one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The row with the smallest id of each group, null ids last.

    Of rows equal in id and text one stays, the same on every run: the first by a
    hash of the columns that can be hashed.
    """
    rows = _grouped(docs, id_col, text_col, shingle, radius)
    best = rows.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "r1", "r2")).alias("best")).select("best.r1", "best.r2")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_keys(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")))
    order = F.xxhash64(*[F.col("row").getField(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"])
    return keyed.join(best, ["r1", "r2"], "left_semi").groupBy("r1", "r2").agg(F.min_by("row", order).alias("row")).select("row.*")
