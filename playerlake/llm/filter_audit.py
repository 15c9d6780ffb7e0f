"""Interaction of filters: what each removes in every order of applying them.

One pass marks the filters that a document fails. Documents are counted by part, mask
of failed filters and labels, map-side first, so a part brings at most 128 rows
however many documents it has. For every mask there is one wide integer whose fields,
64 bits each, hold the outcomes of all 600 steps (120 orders of five filters): a
part's integers, times their counts, are summed and taken apart again. A field holds
up to 2**64 - 1, more than the documents of a part times the 120 orders.

A document repeats an earlier one if its text is that of a smaller doc_id. A text's
smallest doc_id is found by the text's SHA-256 in an aggregate; only the documents
that have it are looked up again, by text and doc_id together, so a text that a third
of all rows share meets in no task.

Defined results: null text is empty; null source is the empty string, as part too; a
null doc_id has no smaller one, repeats nothing and makes no other text a repeat;
repeated rows count as documents, and equal doc_ids are not smaller; a doc_id with
several labels is good or toxic if one of them says so, without labels it is neither;
texts of any length are taken whole; an empty table has no parts, so no rows; other
columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(1, len(FILTERS) + 1)]
OUTCOMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]

#: Fixed values of the filters: words, percent of distinct words, percent of capitals, marks.
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
MARKS = "#$%&*|"

RESULT = ", ".join(["part string", "filter_order string", "step int", *[f"{name} long" for name in [*OUTCOMES, "shapley"]]])


def failures(text: Column) -> list[Column]:
    """Whether a text (not null) fails A, B, C and D."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(inner, r"[\x20\x09-\x0D]+")  # no empty ones, but of an empty text
    n, distinct = [F.when(inner == "", 0).otherwise(F.size(w)) for w in (words, F.array_distinct(words))]
    return [
        n < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.length(text),
        functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(mark)) for mark in MARKS]),
    ]


def count_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by the filters that they fail, A the lowest bit."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    fails = failures(text)
    mask = functools.reduce(lambda a, b: a + b, [F.when(fail, 1 << k).otherwise(0) for k, fail in enumerate(fails)])
    marked = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "doc_id", F.sha2(text, 256).alias("digest"), mask.alias("mask"))
    rows = marked.groupBy("part", "doc_id", "digest", "mask").agg(F.count("*").alias("n"))
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = rows.join(known, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    found = rows.join(first, ["digest", "doc_id"], "left")
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    counted = found.withColumn("mask", F.col("mask") + F.when(repeats, 16).otherwise(0))
    return counted.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


@functools.lru_cache(maxsize=1)
def packed_outcomes() -> dict[tuple[int, bool, bool], int]:
    """The wide integer of each (mask, good, toxic): a field of 64 bits for every step and outcome."""
    packed = {}
    for mask in range(1 << len(FILTERS)):
        fields = np.zeros((len(STEPS), len(OUTCOMES)), "<u8")
        for row, (order, step) in enumerate(STEPS):
            fail = [mask >> FILTERS.index(f) & 1 for f in order]
            here, before = fail[step - 1], any(fail[: step - 1])
            removed = here and not before
            fields[row] = [not before and not here, removed, here and before, here and sum(fail) == 1, removed, removed]
        for good in (False, True):
            for toxic in (False, True):
                packed[mask, good, toxic] = int.from_bytes((fields * np.array([1, 1, 1, 1, good, toxic], "<u8")).tobytes(), "little")
    return packed


def _unpack(table: pa.Table) -> pa.Table:
    """All steps of one part from its counts: at most one row for each mask and label."""
    packed, total = packed_outcomes(), 0
    for mask, good, toxic, n in zip(*[table.column(c).to_pylist() for c in ("mask", "good", "toxic", "n")]):
        total += n * packed[mask, good, toxic]
    fields = np.frombuffer(total.to_bytes(8 * len(STEPS) * len(OUTCOMES), "little"), "<u8").astype(np.int64).reshape(len(STEPS), len(OUTCOMES))
    letters = np.array([order[step - 1] for order, step in STEPS])
    share = {f: int(fields[letters == f, OUTCOMES.index("removed")].sum()) for f in FILTERS}
    columns = [pa.array([table.column("part")[0].as_py()] * len(STEPS)), pa.array([o for o, _ in STEPS]), pa.array([s for _, s in STEPS], pa.int32())]
    columns += [pa.array(fields[:, k]) for k in range(len(OUTCOMES))]
    return pa.Table.from_arrays([*columns, pa.array([share[f] for f in letters], pa.int64())], names=["part", "filter_order", "step", *OUTCOMES, "shapley"])


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step: documents kept, removed, and so on."""
    return count_masks(docs, labels).groupBy("part").applyInArrow(_unpack, RESULT)
