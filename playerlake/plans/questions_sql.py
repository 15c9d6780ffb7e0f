"""The fifteen business questions as SQL over the layer tables.

For users who work in SQL: ``medallion.register_views`` exposes the tables under
these names, and ``spark.sql`` runs the texts as they stand.
"""

from __future__ import annotations

from playerlake.functions.codes import ACTION_COUNT_COLUMNS

_COUNTS = list(ACTION_COUNT_COLUMNS.values())

QUESTIONS = {
    "q_total_players": "SELECT count(DISTINCT PlayerID) AS Players FROM silver_players",
    "q_active_players": """
        SELECT count(DISTINCT PlayerID) AS ActivePlayers
        FROM gold_player_summary
        WHERE IsActive AND AccountAgeDays > 15""",
    "q_new_players": """
        SELECT count(DISTINCT PlayerID) AS NewPlayers
        FROM gold_player_summary
        WHERE AccountAgeDays <= 15""",
    "q_players_by_country": """
        WITH by_country AS (
            SELECT Country, count(DISTINCT PlayerID) AS Players FROM silver_players GROUP BY Country)
        SELECT Country, Players,
               try_divide(Players, (SELECT count(DISTINCT PlayerID) FROM silver_players)) AS PercPlayers
        FROM by_country
        ORDER BY Players DESC, Country""",
    "q_hours_by_action": """
        SELECT FavoriteAction, round(sum(TotalPlayTimeMinutes) / 60) AS HoursPlayed
        FROM gold_player_summary
        GROUP BY FavoriteAction
        ORDER BY HoursPlayed DESC, FavoriteAction""",
    "q_hours_by_platform": """
        SELECT PrimaryPlatform, round(sum(TotalPlayTimeMinutes) / 60) AS HoursPlayed
        FROM gold_player_summary
        GROUP BY PrimaryPlatform
        ORDER BY HoursPlayed DESC, PrimaryPlatform""",
    "q_sessions_by_weekday": """
        SELECT weekday(SessionDate) AS SessionWeekDay,
               count(*) AS sessions,
               round(sum(SessionTimeLength) / 60) AS TotalSessionTimeInHours
        FROM gold_players_info
        GROUP BY SessionWeekDay
        ORDER BY SessionWeekDay""",
    "q_players_by_age_gender": """
        SELECT count(DISTINCT PlayerID) AS Players, AgeBin, Gender
        FROM gold_players_info
        GROUP BY AgeBin, Gender
        ORDER BY AgeBin, Gender""",
    "q_retention": """
        SELECT Players, round(try_divide(Players, sum(Players) OVER ()), 2) AS Percentage, IsActive
        FROM (SELECT IsActive, count(DISTINCT PlayerID) AS Players
              FROM gold_player_summary
              WHERE AccountAgeDays > 15
              GROUP BY IsActive)""",
    "q_feature_mix": (
        "SELECT avg(PlatformDiversity) AS AvgPlatformDiversity, "
        + ", ".join(f"sum({c}) AS sum_{c}" for c in _COUNTS)
        + ", " + " + ".join(f"sum_{c}" for c in _COUNTS) + " AS TotalActions, "
        + ", ".join(f"try_divide(sum_{c}, TotalActions) AS perc_{c}" for c in _COUNTS)
        + " FROM gold_player_summary WHERE IsActive AND AccountAgeDays > 15"
    ),
    "q_revenue_by_month": """
        SELECT sum(ItemPrice) AS Revenue,
               date_format(date_trunc('month', PaymentTimestamp), 'yyyy-MM-01') AS Month
        FROM gold_players_purchases
        GROUP BY Month
        ORDER BY Month""",
    "q_engagement_spend": """
        SELECT PlayerID, TotalSessions, AvgSessionLengthMinutes, TotalPlayTimeMinutes, TotalSpent, AvgPurchaseValue
        FROM gold_player_summary""",
    "q_revenue_by_item": """
        SELECT sum(ItemPrice) AS TotalRevenue, Item
        FROM gold_players_purchases
        GROUP BY Item
        ORDER BY TotalRevenue DESC, Item""",
    "q_transactions_by_payment": """
        SELECT count(DISTINCT TransactionID) AS Transactions, PaymentMethod
        FROM gold_players_purchases
        GROUP BY PaymentMethod""",
    "q_daily_totals": """
        SELECT SessionDate,
               sum(UniqueTransactions) AS UniqueTransactions,
               sum(TotalDailyRevenue) AS TotalDailyRevenue,
               sum(AverageDailyItemPrice) AS AverageDailyItemPrice
        FROM gold_daily_metrics
        GROUP BY SessionDate
        ORDER BY SessionDate""",
}
