"""Null-safe typing of the all-string bronze columns.

Under ANSI mode a single malformed value in ``to_timestamp``/``cast`` aborts the
whole job. Raw files are untrusted, so every conversion here uses the ``try_``
form: a bad value becomes null and the row survives. On clean input the result
is identical to the plain conversion.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date_col(value: str | _dt.date | Column | None) -> Column:
    """An ``as_of`` argument as a date column; ``None`` means today."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        return F.lit(value)
    return F.lit(value).cast("date")


def parse_timestamp(c: str | Column) -> Column:
    """ISO-8601 text (``2025-01-01T10:00:00``) to a session-zone timestamp."""
    return F.try_to_timestamp(as_col(c))


def parse_date(c: str | Column) -> Column:
    return as_col(c).try_cast("date")


def parse_int(c: str | Column) -> Column:
    return as_col(c).try_cast("int")


def parse_double(c: str | Column) -> Column:
    return as_col(c).try_cast("double")


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole-second difference in minutes, as a double (sub-seconds dropped first)."""
    return (F.unix_timestamp(as_col(end)) - F.unix_timestamp(as_col(start))) / 60.0


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator / denominator`` as a double, null instead of a division error."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))
