"""Deterministic duplicate elimination by key.

``dropDuplicates([key])`` keeps an arbitrary row when duplicates differ, so the
result can change between runs and even between a task and its retry after an
executor loss. Here the survivor is fixed: the smallest row in a total order over
the other columns (frame order, ascending, nulls first).

The plan is ``groupBy(key).agg(min(struct(key, others)))``: an aggregate, so Spark
combines map-side before the shuffle. A key that owns a third of all rows is
reduced to one row per map task first; no task ever holds a whole group, which a
``row_number()`` window would need (it sorts every row of the group in one task).
Rows whose key is null collapse into one row, like ``dropDuplicates``.

The survivor is returned whole from the winning struct, key included (the key
is constant within a group, so this changes no value). Spark then does not
treat the output as already partitioned by the key, and a later join on that
key shuffles this side through the planner's own exchange. Adaptive execution
can split a skewed partition only between two such exchanges, so a hot key on
the other (fact) side is still split, exactly as when the dedup output is read
back from a written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WINNER = "__keep_first"


def keep_first(df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``; ties broken by ``order_by`` (default: all other columns).

    Output columns keep the input order. ``order_by`` must list every non-key
    column (in priority order) so the survivor is a complete row.
    """
    key_cols = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in df.columns if c not in key_cols]
    order = list(order_by) if order_by is not None else others
    if sorted(order) != sorted(others):
        raise ValueError("order_by must name every non-key column exactly once")
    survivors = df.groupBy(*key_cols).agg(F.min(F.struct(*key_cols, *order)).alias(_WINNER))
    return survivors.select(*[F.col(f"{_WINNER}.{c}").alias(c) for c in df.columns])
