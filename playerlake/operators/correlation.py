"""Pearson correlation matrix between two groups of numeric columns.

All cells are computed in one global aggregate: sample covariance per pair and
sample standard deviation per variable are running moments combined map-side,
so the shuffle carries one small row per task however many input rows there
are. The single result row is unpivoted with ``stack`` into long form.

``corr`` itself is not used: under ANSI mode it raises a division-by-zero
error when a column is constant (zero variance), which would abort the whole
job. ``cov / (sd_x * sd_y)`` is the same quantity from the same moments, and
``try_divide`` makes an undefined correlation null (fewer than two rows or a
constant column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlation_matrix(
    df: DataFrame,
    row_vars: Sequence[str],
    col_vars: Sequence[str],
    row_name: str = "RowVariable",
    col_name: str = "ColumnVariable",
    value_name: str = "Correlation",
) -> DataFrame:
    """Long-form matrix ``(row_name, col_name, value_name)``; null when undefined."""
    pairs = [(r, c) for r in row_vars for c in col_vars]
    variables = list(dict.fromkeys([*row_vars, *col_vars]))
    sd = {v: f"sd{i}" for i, v in enumerate(variables)}
    moments = df.agg(
        *[F.stddev_samp(v).alias(sd[v]) for v in variables],
        *[F.covar_samp(r, c).alias(f"cov{i}") for i, (r, c) in enumerate(pairs)],
    )
    stacked = [
        arg
        for i, (r, c) in enumerate(pairs)
        for arg in (
            F.lit(r),
            F.lit(c),
            F.try_divide(F.col(f"cov{i}"), F.col(sd[r]) * F.col(sd[c])),
        )
    ]
    return moments.select(F.stack(F.lit(len(pairs)), *stacked)).toDF(row_name, col_name, value_name)
