"""How far the sources of a language differ in the words that they use.

Tasks count terms and the documents that hold them in slices of texts, and Spark adds
the counts up by language, source and term, map-side first. A language keeps the
terms of at least 10 of its documents. Every kept term is a row of source-ordered
counts; equal rows are one row with a multiplicity. Rows are dealt into buckets of
bounded size, each bucket becomes a frequent-pattern tree (``pattern_tree``), and the
trees' sums over pairs of sources add up to the whole. The comparison of a group with
its language needs no pairs: each term's share is compared as it is, and the window
keeps ten for each group before anything is moved.

All arithmetic is exact: shares are integer quotients in decimals of 38 digits, and
terms are told apart by their bytes.

Defined results: null text, lang and source are empty strings; a group without terms,
or a language that keeps none, has its pairs with value 0 where no term is kept;
repeated rows are documents of their own; ties of a value go by the item's bytes;
texts of any length are taken whole; without rows the result is empty; other columns
are not read; malformed bytes are part of a term as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerlake.llm.columns import HASHER, LOWER, bound_batches, ragged, row_slices, text_buffer, word_spans
from playerlake.llm.pattern_tree import Tree
from playerlake.llm.storage import saved

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP = 10

#: Bytes of texts that a task counts at a time, and rows of a tree.
SLICE = 4 << 20
BUCKET = 8192

_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True

COUNTS = "lang string, source string, term string, n long, documents long"


def _equal_bytes(data: np.ndarray, starts: np.ndarray, others: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the ranges from both starts have the same bytes."""
    differs = data[ragged(starts, lengths)] != data[ragged(others, lengths)]
    before = np.concatenate([[0], np.cumsum(differs)])
    edges = np.concatenate([[0], np.cumsum(lengths)])
    return before[edges[1:]] == before[edges[:-1]]


def _slice_counts(data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """(group, start, end, n, documents) of each term of each group of rows."""
    data = LOWER[data]
    starts, ends = word_spans(data, offsets, _TERM)
    hashes = HASHER.ranges(HASHER.prefix(data), starts, ends)
    _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    same = (ends - starts) == (ends - starts)[first][word]
    same[same] = _equal_bytes(data, starts[same], starts[first][word][same], (ends - starts)[same])
    if not same.all():  # two spellings of one hash: the others are numbered by themselves
        rest = np.flatnonzero(~same)
        spelled = [data[a:b].tobytes() for a, b in zip(starts[rest], ends[rest])]
        number = {x: len(first) + k for k, x in enumerate(dict.fromkeys(spelled))}
        word[rest] = [number[x] for x in spelled]
    row = np.searchsorted(offsets, starts, side="right") - 1
    width = int(word.max(initial=0)) + 1
    held, at, times = np.unique(row * width + word, return_index=True, return_counts=True)  # a term of a document
    key, one, which = np.unique(group[held // width] * width + held % width, return_index=True, return_inverse=True)
    n = np.bincount(which, times, len(key)).astype(np.int64)
    some = at[one]
    return key // width, starts[some], ends[some], n, np.bincount(which, minlength=len(key))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        both = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
        number = {pair: k for k, pair in enumerate(dict.fromkeys(both))}
        pairs, group = list(number), np.array([number[pair] for pair in both], np.int64)
        for a, b in row_slices(offsets, SLICE):
            part, edges = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            which, starts, ends, n, documents = _slice_counts(part, edges, group[a:b])
            lengths = ends - starts
            body = LOWER[part[ragged(starts, lengths)]]
            upto = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            terms = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(upto), pa.py_buffer(body))
            of = [pa.array([pair[k] for pair in pairs], pa.string()).take(pa.array(which)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*of, terms, pa.array(n), pa.array(documents)], names=["lang", "source", "term", "n", "documents"])


def count_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, counts): kept terms; counts are (source, n) in the order of sources.

    ``docs`` has lang, source and text without nulls.
    """
    found = docs.select("lang", "source", "text").mapInArrow(_count, COUNTS)
    by_source = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts")
    )
    return by_term.where(F.col("documents") >= least).drop("documents")


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), exact."""
    wide = [c.cast("decimal(19,0)") for c in (n, total, kept)]
    return F.lit(1).cast("long") + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (wide[0] + 2), wide[1] + 2 * wide[2])


def _closeness(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


PAIR_SUMS = "lang string, a int, b int, change long"


def _tree_sums(paths: pa.Table, groups: pa.Table) -> pa.Table:
    """The pairs' sums over one bucket of paths; ``groups`` are all groups of its language."""
    if not len(paths):
        return pa.table({"lang": pa.array([], pa.string()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "change": pa.array([], pa.int64())})
    groups = groups.sort_by("number")
    names = {s: k for k, s in enumerate(groups.column("source").to_pylist())}
    none = groups.column("none").to_numpy()
    lists = paths.column("counts").combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    source = values.field("source").dictionary_encode()
    number = np.array([names[s] for s in source.dictionary.to_pylist()], np.int64)[source.indices.to_numpy()]
    count = values.field("n").to_numpy()
    tree = Tree(number, count, offsets - offsets[0], paths.column("terms").to_numpy())
    total = [int(x) for x in groups.column("divisor").to_pylist()]
    each, which = np.unique(np.stack([tree.group, tree.count]), axis=1, return_inverse=True)
    weight = np.array([1 + SCALE * (n + 2) // total[g] for g, n in each.T.tolist()], np.int64)[which.ravel()]
    sums = tree.pair_sums(weight, none)
    a, b = np.nonzero(sums)
    lang = pa.array([groups.column("lang")[0].as_py()] * len(a), pa.string())
    return pa.table({"lang": lang, "a": pa.array(a.astype(np.int32)), "b": pa.array(b.astype(np.int32)), "change": pa.array(sums[a, b])})


def divergence_audit(docs: DataFrame, *, text_col: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP, bucket: int = BUCKET) -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of sources, and each group's own terms."""
    bound_batches(docs.sparkSession)
    filled = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in (("lang", "lang"), ("source", "source"), (text_col, "text"))])
    terms = saved(count_terms(filled, least), "kept-terms")

    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    each = terms.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", "term", "total", "c.source", "c.n")
    totals = each.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = filled.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("own", "kept", "lang_total")])
    own, kept, everyone = F.col("own"), F.col("kept"), F.col("lang_total")
    groups = groups.withColumns({
        "number": F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1,
        "divisor": own.cast("decimal(38,0)") + 2 * kept.cast("decimal(19,0)"),
        "none": F.when(kept > 0, share(F.lit(0), own, kept)),
    })
    groups = saved(groups, "groups")

    buckets = F.greatest(F.lit(1), F.ceil(F.col("kept") / bucket))
    path_rows = terms.groupBy("lang", "counts").agg(F.count("*").alias("terms")).join(langs.select("lang", "kept"), "lang")
    path_rows = path_rows.select("lang", "counts", "terms", F.pmod(F.xxhash64("counts"), buckets).alias("bucket"))
    bucket_groups = groups.where("kept > 0").select("lang", "source", "number", "none", "divisor", F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)).alias("bucket"))
    sums = path_rows.groupBy("lang", "bucket").cogroup(bucket_groups.groupBy("lang", "bucket")).applyInArrow(_tree_sums, PAIR_SUMS)
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("change").alias("change"))

    one = groups.select("lang", "source", "number", "none", "kept")
    two = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("other"), F.col("none").alias("other_none"))
    both = one.join(two, "lang").where("number <> other").withColumns({"a": F.least("number", "other"), "b": F.greatest("number", "other")})
    base = F.when(F.col("kept") > 0, F.col("kept") * _closeness("none", "other_none")).otherwise(0)
    pairs = both.join(sums, ["lang", "a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", (base + F.coalesce("change", F.lit(0))).alias("value"))

    shares = each.join(groups.select("lang", "source", "own", "kept", "lang_total"), ["lang", "source"])
    shares = shares.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), own, kept).alias("p"), share(F.col("total"), everyone, kept).alias("q")).where("p > q")
    own_terms = shares.select("lang", "source", F.lit("term").alias("part"), "item", _closeness("p", "q").alias("value"))

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [part.withColumn("rank", F.row_number().over(order)) for part in (pairs, own_terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
