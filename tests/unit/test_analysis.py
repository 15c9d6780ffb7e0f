"""Analysis questions on hand-made gold tables."""

from __future__ import annotations

import datetime as dt

from playerlake.plans import analysis

SUMMARY = (
    "PlayerID string, Country string, TotalSessions bigint, AvgSessionLengthMinutes double, "
    "TotalPlayTimeMinutes double, IsActive boolean, AccountAgeDays int, PlatformDiversity bigint, "
    "FavoriteAction string, PrimaryPlatform string, "
    + ", ".join(f"{c} bigint" for c in [
        "PvP_Battle_Count", "Dungeon_Raid_Count", "Crafting_Count", "Exploration_Count",
        "Trading_Count", "Gathering_Count", "Questing_Story_Progression_Count",
        "Social_Interaction_Count"])
    + ", TotalSpent double, AvgPurchaseValue double"
)


def _summary(spark, rows):
    return spark.createDataFrame(rows, SUMMARY)


def _row(pid, active, age, counts, minutes=90.0, spent=10.0):
    return (pid, "US", 2, 45.0, minutes, active, age, 2, "PvP Battle", "Mobile", *counts, spent, spent / 2)


def test_feature_mix_zero_actions_gives_null_shares(spark):
    df = _summary(spark, [_row("P1", True, 30, [0] * 8)])
    row = analysis.feature_mix(df).collect()[0]
    assert row.TotalActions == 0 and row.perc_PvP_Battle_Count is None
    assert len(df.columns) and len(row) == 18


def test_feature_mix_shares_sum_to_one(spark):
    df = _summary(spark, [_row("P1", True, 30, [1, 2, 3, 4, 0, 0, 0, 2]),
                          _row("P2", True, 16, [1, 0, 0, 0, 0, 0, 0, 0]),
                          _row("P3", False, 30, [9] * 8), _row("P4", True, 15, [9] * 8)])
    row = analysis.feature_mix(df).collect()[0]
    assert row.TotalActions == 13 and row.sum_PvP_Battle_Count == 2
    assert abs(sum(row[c] for c in row.__fields__ if c.startswith("perc_")) - 1.0) < 1e-12


def test_counts_and_retention(spark):
    df = _summary(spark, [_row("P1", True, 30, [1] * 8), _row("P2", False, 30, [1] * 8),
                          _row("P3", True, 10, [1] * 8), _row("P4", True, 16, [1] * 8)])
    assert analysis.active_players(df).collect()[0].ActivePlayers == 2
    assert analysis.new_players(df).collect()[0].NewPlayers == 1
    shares = {r.IsActive: (r.Players, r.Percentage) for r in analysis.retention(df).collect()}
    assert shares == {True: (2, 0.67), False: (1, 0.33)}


def test_players_by_country_shares(spark):
    players = spark.createDataFrame(
        [("P1", "US"), ("P2", "US"), ("P3", "BR"), ("P4", None)], "PlayerID string, Country string"
    )
    rows = analysis.players_by_country(players).collect()
    assert rows[0].Country == "US" and rows[0].Players == 2 and rows[0].PercPlayers == 0.5
    assert sum(r.PercPlayers for r in rows) == 1.0


def test_weekday_and_month(spark):
    info = spark.createDataFrame(
        [(dt.date(2025, 3, 3), 60.0), (dt.date(2025, 3, 9), 30.0), (dt.date(2025, 3, 9), 60.0)],
        "SessionDate date, SessionTimeLength double",
    )
    rows = [tuple(r) for r in analysis.sessions_by_weekday(info).collect()]
    assert rows == [(0, 1, 1.0), (6, 2, 2.0)]  # Monday = 0, Sunday = 6; 1.5 h rounds half up
    paid = spark.createDataFrame(
        [(dt.datetime(2025, 2, 28, 23, 59, 59), 1.0), (dt.datetime(2025, 3, 1), 2.0)],
        "PaymentTimestamp timestamp, ItemPrice double",
    )
    assert [tuple(r) for r in analysis.revenue_by_month(paid).collect()] == [
        (1.0, "2025-02-01"), (2.0, "2025-03-01")]


def test_correlation_matrix_long_form(spark):
    df = _summary(spark, [_row(f"P{i}", True, 30, [1] * 8, minutes=10.0 * i, spent=2.0 * i + 1)
                          for i in range(1, 6)])
    out = {(r.RowVariable, r.ColumnVariable): r.Correlation
           for r in analysis.engagement_spend_correlation(df).collect()}
    assert len(out) == 6
    assert abs(out[("TotalSpent", "TotalPlayTimeMinutes")] - 1.0) < 1e-12


def test_correlation_undefined_is_null_not_an_error(spark):
    df = _summary(spark, [_row("P1", True, 30, [1] * 8, minutes=10.0, spent=3.0)])
    assert {r.Correlation for r in analysis.engagement_spend_correlation(df).collect()} == {None}
