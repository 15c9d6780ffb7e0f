"""Silver layer: rename, deduplicate, type and decode the bronze tables.

Each function is ``bronze DataFrame -> silver DataFrame`` with one shuffle (the
dedup); everything else is a narrow projection fused into the same codegen
stage. Dedup runs on the raw text *before* typing and decoding: the same rows
survive (the tie-break order is over the raw columns), and the parse/decode work
is done once per surviving row instead of once per duplicate. The dedup proves the table's
unique key, which goes with the frame (``facts``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
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
from playerlake.facts import with_facts
from playerlake.functions.parse import (
    minutes_between,
    parse_date,
    parse_double,
    parse_int,
    parse_timestamp,
)
from playerlake.operators.dedup import keep_first

# Raw field -> column of the silver table.
GAME_LOG_NAMES = {
    "_player_id": "PlayerID",
    "_session_id": "SessionID",
    "_login": "LoginTime",
    "_logout": "LogoutTime",
    "_action": "Actions",
    "_platform": "Platform",
}

PLAYER_NAMES = {
    "plid": "PlayerID",
    "country": "Country",
    "age": "Age",
    "acc_creat_date": "AccountCreationDate",
    "gender": "Gender",
}

PURCHASE_NAMES = {
    "transaction_id": "TransactionID",
    "player_id": "PlayerID",
    "item": "Item",
    "item_price": "ItemPrice",
    "pmethod": "PaymentMethod",
    "time": "Timestamp",
}


def _renamed(bronze: DataFrame, names: dict[str, str]) -> DataFrame:
    return bronze.select(*[F.col(src).alias(dst) for src, dst in names.items()])


def clean_game_logs(bronze: DataFrame) -> DataFrame:
    """One row per SessionID, typed; SessionTimeLength in minutes (double)."""
    raw = keep_first(_renamed(bronze, GAME_LOG_NAMES), "SessionID")
    login = parse_timestamp("LoginTime")
    logout = parse_timestamp("LogoutTime")
    typed = raw.select(
        "PlayerID",
        "SessionID",
        login.alias("LoginTime"),
        logout.alias("LogoutTime"),
        decode_array("Actions", ACTIONS).alias("Actions"),
        decode("Platform", PLATFORMS).alias("Platform"),
        minutes_between(login, logout).alias("SessionTimeLength"),
    )
    return with_facts(typed, ["SessionID"])


def clean_players(bronze: DataFrame) -> DataFrame:
    """One row per PlayerID; Age int, AgeBin label, AccountCreationDate date."""
    raw = keep_first(_renamed(bronze, PLAYER_NAMES), "PlayerID")
    typed = raw.select(
        "PlayerID",
        "Country",
        parse_int("Age").alias("Age"),
        parse_date("AccountCreationDate").alias("AccountCreationDate"),
        decode("Gender", GENDERS).alias("Gender"),
    )
    return with_facts(typed.withColumn("AgeBin", bin_by("Age")), ["PlayerID"])


def clean_purchases(bronze: DataFrame) -> DataFrame:
    """One row per TransactionID; ItemPrice double, Timestamp timestamp."""
    raw = keep_first(_renamed(bronze, PURCHASE_NAMES), "TransactionID")
    typed = raw.select(
        "TransactionID",
        "PlayerID",
        decode("Item", ITEMS).alias("Item"),
        parse_double("ItemPrice").alias("ItemPrice"),
        decode("PaymentMethod", PAYMENT_METHODS).alias("PaymentMethod"),
        parse_timestamp("Timestamp").alias("Timestamp"),
    )
    return with_facts(typed, ["TransactionID"])
