"""Distinct counts that avoid Spark's distinct-aggregate rewrite where it is safe.

``count(DISTINCT c)`` next to other aggregates is planned as an ``Expand`` (one
copy of every input row per distinct column, plus one for the rest) followed by
a two-level aggregate. On session-grain data that multiplies the shuffle. A
column that is already a unique *key* of the input (SessionID after the silver
dedup and a many-to-one join) needs none of it: ``count`` is exact and combines
map-side into one row per group and task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_unique_key(c: str, unique: bool = False) -> Column:
    """Distinct count of a column; ``unique`` says that it is a unique key of the input."""
    return F.count(c) if unique else F.count_distinct(c)
