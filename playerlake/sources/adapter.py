"""Bronze-shaped frames derived from the driver's TPC-H-style tables.

The test data has no game tables, so players, sessions and purchases are
derived column by column from ``customer``/``nation``, ``events`` and
``lineitem``/``orders``. Every column is a deterministic expression, which lets
an independent SQL engine derive the very same rows for the oracle check. The
frames have exactly the bronze landing schema (all strings), so everything
downstream runs unchanged on real raw files.

All derivations are narrow projections plus one equi-join each against a
dimension (nation, orders); Catalyst prunes the unread columns at the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playerlake.sources.tables import read_driver_table

# Fixed values of the fixture derivation: the as-of date players' account ages
# are measured from, and the start of the 90 days purchases are spread over.
ADAPTER_AS_OF = _dt.date(2024, 2, 14)
PURCHASES_EPOCH = "2023-11-16 00:00:00"
PURCHASES_SPREAD_SECONDS = 7_776_000
DRIVER_TABLES = ["customer", "nation", "events", "lineitem", "orders"]
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _padded_id(prefix: str, number, width: int):
    """The prefix and the number, padded to ``width`` digits and never cut."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bronze_players`` shape from customer x nation."""
    customer = read_driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner").select(
        _padded_id("P", key, 6).alias("plid"),
        F.col("n_name").alias("country"),
        (F.lit(8) + (key * 7) % 65).cast("string").alias("age"),
        F.date_format(
            F.date_sub(F.lit(ADAPTER_AS_OF), ((key * 13) % 400).cast("int")), "yyyy-MM-dd"
        ).alias("acc_creat_date"),
        (key % 4).cast("string").alias("gender"),
    )


def game_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bronze_game_logs`` shape from events (``k`` = the integer in ``props``)."""
    events = read_driver_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    k = F.regexp_extract("props", "[0-9]+", 0).try_cast("bigint")
    event_id = F.col("event_id")
    logout = F.col("ts") + F.make_dt_interval(
        secs=F.floor(F.col("value") * 60).cast("bigint")
    )
    return events.withColumn("k", k).select(
        _padded_id("P", F.col("user_id"), 6).alias("_player_id"),
        _padded_id("S", event_id, 7).alias("_session_id"),
        F.date_format("ts", ISO_SECONDS).alias("_login"),
        F.date_format(logout, ISO_SECONDS).alias("_logout"),
        F.array(
            (F.col("k") % 9).cast("string"),
            (F.expr("k div 9") % 9).cast("string"),
            (event_id % 8).cast("string"),
        ).alias("_action"),
        (event_id % 5).cast("string").alias("_platform"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bronze_purchases`` shape from lineitem x orders (duplicate ids occur)."""
    lineitem = read_driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"
    )
    orders = read_driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    orderkey, line = F.col("l_orderkey"), F.col("l_linenumber")
    offset = (orderkey * 7919 + line * 131) % PURCHASES_SPREAD_SECONDS
    paid_at = F.lit(PURCHASES_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        secs=offset.cast("bigint")
    )
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner").select(
        _padded_id("T", orderkey * 10 + line, 9).alias("transaction_id"),
        _padded_id("P", F.col("o_custkey"), 6).alias("player_id"),
        (F.col("l_partkey") % 16).cast("string").alias("item"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("item_price"),
        (line % 4).cast("string").alias("pmethod"),
        F.date_format(paid_at, ISO_SECONDS).alias("time"),
    )


def bronze_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Source name -> bronze-shaped frame, keyed like ``schemas.SOURCES``."""
    return {
        "game_logs": game_logs(spark, sf_dir),
        "player_profiles": players(spark, sf_dir),
        "purchases": purchases(spark, sf_dir),
    }
