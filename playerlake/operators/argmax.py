"""Row-wise arg-max over a fixed set of count columns, with priority tie-break.

``greatest`` is one codegen'd expression; the label is the first column (in the
given priority order) that reaches it. This equals "the first label whose count
is >= every other count" as long as the counts are non-null, which holds for the
conditional-count columns this is used on (they are sums of 0/1 over a group).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def priority_argmax(label_to_column: Mapping[str, str]) -> Column:
    """Label of the largest column; earlier entries win ties. All-zero -> first label."""
    items = list(label_to_column.items())
    if len(items) < 2:
        raise ValueError("need at least two columns")
    top = F.greatest(*[F.col(c) for _, c in items])
    expr = None
    for label, column in items[:-1]:
        cond = F.col(column) == top
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(items[-1][0])
