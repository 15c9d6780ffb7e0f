"""Declared landing schemas of the three raw sources.

Raw files are never schema-inferred: every field lands as a nullable string (or
an array of strings) and is typed in the silver layer. JSON numbers read into a
string field keep their text, so ``[0, 3]`` lands as ``["0", "3"]``.
"""

from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Field names, order and types of the raw files.
GAME_LOGS_SCHEMA = StructType([
    StructField("_player_id", StringType(), True),
    StructField("_session_id", StringType(), True),
    StructField("_login", StringType(), True),
    StructField("_logout", StringType(), True),
    StructField("_action", ArrayType(StringType()), True),
    StructField("_platform", StringType(), True),
])

PLAYERS_SCHEMA = StructType([
    StructField("plid", StringType(), True),
    StructField("country", StringType(), True),
    StructField("age", StringType(), True),
    StructField("acc_creat_date", StringType(), True),
    StructField("gender", StringType(), True),
])

PURCHASES_SCHEMA = StructType([
    StructField("transaction_id", StringType(), True),
    StructField("player_id", StringType(), True),
    StructField("item", StringType(), True),
    StructField("item_price", StringType(), True),
    StructField("pmethod", StringType(), True),
    StructField("time", StringType(), True),
])

# source name -> (file format, reader options, schema)
SOURCES = {
    "game_logs": ("json", {}, GAME_LOGS_SCHEMA),
    "player_profiles": ("csv", {"header": "true"}, PLAYERS_SCHEMA),
    "purchases": ("csv", {"header": "true"}, PURCHASES_SCHEMA),
}
