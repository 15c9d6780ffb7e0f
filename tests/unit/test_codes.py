"""Code-table decodes and age bins (FIXTURES §2 edge rows)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from playerlake.functions.codes import (
    ACTIONS,
    GENDERS,
    ITEMS,
    PAYMENT_METHODS,
    PLATFORMS,
    bin_by,
    decode,
    decode_array,
)


@pytest.mark.parametrize(
    "table,known,label",
    [
        (PLATFORMS, "1", "Personal Computer"),
        (GENDERS, "3", "Unspecified"),
        (ITEMS, "14", "Premium Dye Pack"),
        (PAYMENT_METHODS, "3", "GiftCard"),
    ],
)
def test_decode_known_unknown_and_null(spark, table, known, label):
    df = spark.createDataFrame([(known,), ("7",), ("15",), ("0",), ("9",), (None,)], "c string")
    by_name = [r[0] for r in df.select(decode("c", table)).collect()]
    by_column = [r[0] for r in df.select(decode(F.col("c"), table)).collect()]
    expected = [label] + [table.get(v, "Unknown") for v in ["7", "15", "0", "9"]] + ["Unknown"]
    assert by_name == expected
    assert by_column == expected


def test_decode_array_elements_and_null_array(spark):
    df = spark.createDataFrame(
        [(["0", "9", None],), ([],), (None,), (["7", "6"],)], "a array<string>"
    )
    out = [r[0] for r in df.select(decode_array("a", ACTIONS)).collect()]
    assert out == [
        ["PvP Battle", "Unknown", "Unknown"],
        [],
        None,
        ["Social Interaction", "Questing / Story Progression"],
    ]


def test_age_bins_half_open(spark):
    ages = [14, 15, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, None]
    df = spark.createDataFrame([(a,) for a in ages], "Age int")
    expected = [
        "Under 15", "15-24", "15-24", "25-34", "25-34", "35-44", "35-44",
        "45-54", "45-54", "55-64", "55-64", "65+", "Unknown",
    ]
    assert [r[0] for r in df.select(bin_by("Age")).collect()] == expected
    assert [r[0] for r in df.select(bin_by(F.col("Age"))).collect()] == expected


def test_decode_quotes_labels_safely(spark):
    table = {"1": "it's", "2": "back\\slash"}
    df = spark.createDataFrame([("1",), ("2",)], "c string")
    assert [r[0] for r in df.select(decode("c", table)).collect()] == ["it's", "back\\slash"]
