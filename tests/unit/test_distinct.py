"""Several distinct counts and distinct rows, against Spark's own forms."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from playerlake.operators import distinct
from playerlake.operators.distinct import distinct_counts, distinct_rows, join_groups

SCHEMA = "g string, h int, a string, b double, c date, wide string"


def _rows(spark, n=400):
    rng = random.Random(1)
    values = [(rng.choice(["x", "y", None]), rng.choice([1, None]), rng.choice(["p", "q", None]), rng.choice([0.0, -0.0, float("nan"), 1.5, None]), None, rng.choice(["long " * 50, "", None])) for _ in range(n)]
    return spark.createDataFrame(values + [("only nulls", 2, None, None, None, None)], SCHEMA)


def _sorted(df):
    """Rows as text: equal numbers (0.0 and -0.0, any NaN) are spelled alike."""
    return sorted(repr(tuple(r)).replace("-0.0", "0.0") for r in df.collect())


def test_counts_equal_count_distinct(spark):
    df = _rows(spark)
    got = distinct_counts(df, ["g", "h"], {"na": "a", "nb": "b", "nc": "c"})
    want = df.groupBy("g", "h").agg(F.count_distinct("a").alias("na"), F.count_distinct("b").alias("nb"), F.count_distinct("c").alias("nc"))
    assert _sorted(got) == _sorted(want) and got.schema["nb"].dataType == want.schema["nb"].dataType
    assert distinct_counts(df.limit(0), ["g"], {"na": "a"}).count() == 0


def test_groups_with_null_keys_meet(spark):
    df = _rows(spark)
    both = join_groups(distinct_counts(df, ["g", "h"], {"na": "a"}), df.groupBy("g", "h").agg(F.count("*").alias("n")), ["g", "h"])
    assert both.columns == ["g", "h", "na", "n"] and both.agg(F.sum("n")).collect()[0][0] == 401


def test_distinct_rows_equal_distinct(spark):
    df = _rows(spark).unionAll(spark.createDataFrame([("once", 7, "p", 1.0, None, "w")], SCHEMA))
    assert _sorted(distinct_rows(df)) == _sorted(df.distinct())
    assert distinct_rows(df.limit(0)).count() == 0


def test_different_rows_of_one_hash_both_stay(spark, monkeypatch):
    monkeypatch.setattr(distinct.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "x int, y string")
    assert _sorted(distinct_rows(df)) == ["(1, 'a')", "(2, 'b')", "(3, 'c')"]


def test_a_third_of_equal_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("x"), F.lit("wide").alias("y"))
    assert distinct_rows(df).count() == 2001
    assert distinct_counts(df, ["y"], {"n": "x"}).collect()[0].n == 2001
