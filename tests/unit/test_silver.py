"""Silver cleaning: dedup, typing, bad input (FIXTURES §2)."""

from __future__ import annotations

import datetime as dt

from playerlake.plans import silver
from playerlake.sources.schemas import GAME_LOGS_SCHEMA, PLAYERS_SCHEMA, PURCHASES_SCHEMA


def _logs(spark, rows):
    return spark.createDataFrame(rows, GAME_LOGS_SCHEMA)


def test_session_minutes_and_decodes(spark):
    bronze = _logs(spark, [("P1", "S1", "2025-01-01T10:00:00", "2025-01-01T11:30:30", ["0", "3"], "2")])
    row = silver.clean_game_logs(bronze).collect()[0]
    assert row.SessionTimeLength == 90.5
    assert row.LoginTime == dt.datetime(2025, 1, 1, 10, 0, 0)
    assert row.Actions == ["PvP Battle", "Exploration"]
    assert row.Platform == "PlayStation 5"


def test_dedup_keeps_smallest_row_by_raw_columns(spark):
    rows = [
        ("P2", "S1", "2025-01-01T10:00:00", "2025-01-01T10:10:00", ["1"], "1"),
        ("P1", "S1", "2025-01-02T10:00:00", "2025-01-02T10:10:00", ["2"], "4"),
        ("P1", "S1", "2025-01-01T09:00:00", "2025-01-01T10:10:00", ["3"], "3"),
        (None, None, None, None, None, None),
        ("P9", None, "2025-01-01T09:00:00", None, [], "1"),
    ]
    out = silver.clean_game_logs(_logs(spark, rows)).collect()
    by_id = {r.SessionID: r for r in out}
    assert len(out) == 2  # one per key, null keys collapse into one row
    assert by_id["S1"].PlayerID == "P1"
    assert by_id["S1"].Platform == "Xbox Series X"  # the 09:00 login sorts first
    assert by_id[None].PlayerID is None  # nulls first inside the tie-break


def test_dedup_is_input_order_invariant(spark):
    rows = [
        ("T1", "P1", "3", "9.99", "1", "2025-01-01T10:00:00"),
        ("T1", "P1", "2", "9.99", "1", "2025-01-01T10:00:00"),
        ("T1", "P0", "5", "1.00", "2", "2025-01-03T10:00:00"),
        ("T2", "P3", "1", "2.50", "3", "2025-01-02T00:00:00"),
    ]
    a = silver.clean_purchases(spark.createDataFrame(rows, PURCHASES_SCHEMA)).collect()
    b = silver.clean_purchases(spark.createDataFrame(rows[::-1], PURCHASES_SCHEMA).repartition(3)).collect()
    assert sorted(a) == sorted(b)
    t1 = [r for r in a if r.TransactionID == "T1"][0]
    assert (t1.PlayerID, t1.Item, t1.ItemPrice, t1.PaymentMethod) == ("P0", "Cosmetic Outfit Box", 1.0, "PayPal")


def test_bad_values_become_null_without_failing(spark):
    players = spark.createDataFrame(
        [("P1", "US", "x", "2024-13-01", "9"), ("P2", "BR", None, "junk", None),
         ("P3", "DE", "24", "2024-05-01", "1")],
        PLAYERS_SCHEMA,
    )
    out = {r.PlayerID: r for r in silver.clean_players(players).collect()}
    assert out["P1"].Age is None and out["P1"].AgeBin == "Unknown"
    assert out["P1"].AccountCreationDate is None and out["P1"].Gender == "Unknown"
    assert out["P2"].AccountCreationDate is None and out["P2"].AgeBin == "Unknown"
    assert out["P3"].Age == 24 and out["P3"].AgeBin == "15-24"
    assert out["P3"].AccountCreationDate == dt.date(2024, 5, 1) and out["P3"].Gender == "Male"

    logs = _logs(spark, [("P1", "S1", "junk", "2025-01-01T10:00:00", ["1"], "1")])
    row = silver.clean_game_logs(logs).collect()[0]
    assert row.LoginTime is None and row.SessionTimeLength is None

    purchases = spark.createDataFrame([("T1", "P1", "1", "abc", "1", "nope")], PURCHASES_SCHEMA)
    row = silver.clean_purchases(purchases).collect()[0]
    assert row.ItemPrice is None and row.Timestamp is None


def test_broken_json_line_lands_as_all_null_row(spark, scratch):
    from playerlake.session import local_path

    landing = local_path(scratch) + "/raw"
    import os

    os.makedirs(landing, exist_ok=True)
    with open(f"{landing}/part-0.json", "w") as fh:
        fh.write('{"_player_id": "P1", "_session_id": "S1", "_login": "2025-01-01T10:00:00", '
                 '"_logout": "2025-01-01T10:05:00", "_action": [0, 3], "_platform": 1}\n')
        fh.write('{"_player_id": "P2", "_session_id": \n')
    bronze = spark.read.schema(GAME_LOGS_SCHEMA).json(landing)
    rows = sorted(bronze.collect(), key=lambda r: r._player_id or "")
    assert rows[0] == (None, None, None, None, None, None)
    assert rows[1]._action == ["0", "3"] and rows[1]._platform == "1"
    assert silver.clean_game_logs(bronze).count() == 2  # kept as one null-key row


def test_column_contracts(spark):
    logs = silver.clean_game_logs(_logs(spark, []))
    assert logs.dtypes == [
        ("PlayerID", "string"), ("SessionID", "string"), ("LoginTime", "timestamp"),
        ("LogoutTime", "timestamp"), ("Actions", "array<string>"), ("Platform", "string"),
        ("SessionTimeLength", "double"),
    ]
    players = silver.clean_players(spark.createDataFrame([], PLAYERS_SCHEMA))
    assert players.dtypes == [
        ("PlayerID", "string"), ("Country", "string"), ("Age", "int"),
        ("AccountCreationDate", "date"), ("Gender", "string"), ("AgeBin", "string"),
    ]
    purchases = silver.clean_purchases(spark.createDataFrame([], PURCHASES_SCHEMA))
    assert purchases.dtypes == [
        ("TransactionID", "string"), ("PlayerID", "string"), ("Item", "string"),
        ("ItemPrice", "double"), ("PaymentMethod", "string"), ("Timestamp", "timestamp"),
    ]
