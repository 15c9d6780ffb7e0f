"""Distinct rows and several distinct counts, without a copy of each wide row.

``count(DISTINCT a), count(DISTINCT b)`` next to other aggregates is planned as an
``Expand``: one copy of every input row for each distinct column, with all columns that
any aggregate reads. ``distinct_counts`` takes only the group and one value for each
column, drops equal ones map-side, and counts what is left, all columns in one
aggregate in two stages.

``SELECT DISTINCT *`` shuffles every row whole. ``distinct_rows`` first counts 128-bit
hashes, 16 bytes a row, and moves only rows whose hash occurs again; these are compared
as they are, so two different rows of one hash both stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, keys: Sequence[str], counted: Mapping[str, str]) -> DataFrame:
    """``keys`` and, for each name of ``counted``, the number of distinct non-null values of its column.

    Null keys are a group like any other; a group with nulls only counts 0.
    """
    columns = list(counted.values())
    slots = [f"__v{k}" for k in range(len(columns))]

    def only(k: int):
        return F.struct(*[(F.col(c) if j == k else F.lit(None).cast(df.schema[c].dataType)).alias(slots[j]) for j, c in enumerate(columns)])

    values = df.select(*keys, F.explode(F.array(*[only(k) for k in range(len(columns))])).alias("__v")).select(*keys, "__v.*")
    once = values.groupBy(*keys, *slots).agg(F.lit(1).alias("__one"))
    return once.groupBy(*keys).agg(*[F.count(slot).alias(name) for slot, name in zip(slots, counted)])


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two aggregates of the same groups side by side; null keys meet."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    return left.join(renamed, same, "inner").drop(*[f"__right_{k}" for k in keys])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row once. Rows that occur once are not shuffled when few occur again."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    hashes = [F.xxhash64(*columns).alias("__h1"), F.xxhash64(F.lit(1), *columns).alias("__h2")]
    again = df.select(*hashes).groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    marked = df.select(*columns, *hashes)
    alone = marked.join(again, ["__h1", "__h2"], "left_anti").select(*columns)
    several = marked.join(again, ["__h1", "__h2"], "left_semi").select(*columns)
    return alone.unionAll(several.distinct())
