"""Every registered query equals its DuckDB oracle (sf0.001; the driver checks sf0.01)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from playerlake.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, _rows


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())
    assert len(QUERIES) == 65


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, df.collect()) == _rows(d_cols, cur.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 25 and df.count() > 0


SPARK_TO_DUCKDB = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]",
}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("bronze_", "table_"))))
def test_column_types_match_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    oracle_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCKDB[t] for c, t in df.dtypes} == oracle_types
