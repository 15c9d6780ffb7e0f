"""The comparison form rounds doubles identically in Spark and in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import comparable
from duckdb_oracle.sql import digits

VALUES = [
    53636.0740625,          # exact tie at 6 digits (average of cents over 32 rows)
    1716354.37,             # money sum, 2 digits
    0.1 + 0.2,              # last-bit noise
    1716354.3699999999,     # summation-order noise below the rounding digit
    -2.5e-7,
    123456789.125,
    None,
]


@pytest.mark.parametrize("column", ["AverageDailyItemPrice", "TotalSpent", "TotalPlayTimeMinutes"])
def test_rounding_matches_duckdb(spark, column):
    df = spark.createDataFrame([(v,) for v in VALUES], f"{column} double")
    ours = [r[0] for r in comparable(df).collect()]
    d = digits(column)
    con = duckdb.connect()
    theirs = [
        con.execute(f"SELECT CAST(round(TRY_CAST(?::DOUBLE AS DECIMAL(38,{d + 3})), {d}) AS DOUBLE)",
                    [v]).fetchone()[0]
        for v in VALUES
    ]
    assert ours == theirs
