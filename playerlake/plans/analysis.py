"""The business questions, as DataFrame plans over the silver/gold tables.

1. How do players engage?          total/active/new players, players by country,
                                    hours by favourite action and platform,
                                    sessions by weekday, players by age and gender
2. Which features drive retention? active share, feature mix of active players
3. How do purchases drive revenue? revenue by month and item, payment methods,
                                    daily totals, engagement vs spend

Every figure taken from ``gold_player_summary`` counts *purchasing* players,
since that table only holds players with sessions, actions and purchases.
Ratios use ``try_divide`` so an empty input gives null instead of an ANSI
division error. Results are sorted only where the question asks for an order
(``ORDERS``); ties go by the columns after it, so the order is total, and
``with_position`` writes it down as a column. Where a table's key is known
(``playerlake.facts``), players are counted without looking for equal ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playerlake.facts import has_key
from playerlake.functions.codes import ACTION_COUNT_COLUMNS
from playerlake.functions.parse import safe_ratio
from playerlake.operators.aggregates import count_unique_key
from playerlake.operators.correlation import correlation_matrix
from playerlake.operators.distinct import distinct_rows

ESTABLISHED_AFTER_DAYS = 15

ENGAGEMENT_VARS = ["TotalSessions", "AvgSessionLengthMinutes", "TotalPlayTimeMinutes"]
SPEND_VARS = ["TotalSpent", "AvgPurchaseValue"]


#: Question -> the order it asks for, then what decides ties; a minus is descending.
ORDERS = {
    "q_players_by_country": ["-Players", "Country"],
    "q_hours_by_action": ["-HoursPlayed", "FavoriteAction"],
    "q_hours_by_platform": ["-HoursPlayed", "PrimaryPlatform"],
    "q_sessions_by_weekday": ["SessionWeekDay"],
    "q_players_by_age_gender": ["AgeBin", "Gender"],
    "q_revenue_by_month": ["Month"],
    "q_revenue_by_item": ["-TotalRevenue", "Item"],
    "q_daily_totals": ["SessionDate"],
}


def _order(question: str) -> list:
    """Ascending columns have nulls first, descending ones nulls last, as Spark sorts."""
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ORDERS[question]]


def with_position(answer: DataFrame, question: str) -> DataFrame:
    """A sorted question's answer and each row's place, from 1: one row a group, so one task sorts few."""
    return answer.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*_order(question))))


def _players(table: DataFrame, unique_ids: bool | None = None):
    """Count of the players of a table: of its rows where PlayerID is its key."""
    return count_unique_key("PlayerID", has_key(table, "PlayerID") if unique_ids is None else unique_ids)


def _established(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("AccountAgeDays") > ESTABLISHED_AFTER_DAYS)


def _active_established(summary: DataFrame) -> DataFrame:
    return summary.where(
        (F.col("IsActive") == F.lit(True)) & (F.col("AccountAgeDays") > ESTABLISHED_AFTER_DAYS)
    )


# 1. Engagement ---------------------------------------------------------------


def total_players(players: DataFrame) -> DataFrame:
    return players.agg(_players(players).alias("Players"))


def active_players(summary: DataFrame) -> DataFrame:
    """Established (account older than 15 days) players active in the last 15 days."""
    return _active_established(summary).agg(_players(summary).alias("ActivePlayers"))


def new_players(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("AccountAgeDays") <= ESTABLISHED_AFTER_DAYS).agg(
        _players(summary).alias("NewPlayers")
    )


def _with_share(groups: DataFrame, share: str, total, unique_ids: bool):
    """``groups`` with each one's Players over all: the sum over the groups if a player is in one only."""
    if unique_ids:
        everyone = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return groups.withColumn(share, safe_ratio("Players", F.sum("Players").over(everyone)))
    return groups.withColumn(share, safe_ratio("Players", total().scalar()))


def players_by_country(players: DataFrame, unique_ids: bool | None = None) -> DataFrame:
    """Players per country and their share of all players.

    Where a player has one row (known, or said by ``unique_ids``) the total is the
    sum over the countries, one pass; otherwise a scalar subquery counts it.
    """
    unique_ids = has_key(players, "PlayerID") if unique_ids is None else unique_ids
    count = _players(players, unique_ids)
    groups = players.groupBy("Country").agg(count.alias("Players"))
    shares = _with_share(groups, "PercPlayers", lambda: players.agg(F.count_distinct("PlayerID")), unique_ids)
    return shares.orderBy(*_order("q_players_by_country"))


def _hours_by(summary: DataFrame, key: str, question: str) -> DataFrame:
    return (
        summary.groupBy(key)
        .agg(F.round(F.sum("TotalPlayTimeMinutes") / 60).alias("HoursPlayed"))
        .orderBy(*_order(question))
    )


def hours_by_action(summary: DataFrame) -> DataFrame:
    return _hours_by(summary, "FavoriteAction", "q_hours_by_action")


def hours_by_platform(summary: DataFrame) -> DataFrame:
    return _hours_by(summary, "PrimaryPlatform", "q_hours_by_platform")


def sessions_by_weekday(info: DataFrame) -> DataFrame:
    """Sessions and hours per weekday (Monday = 0 ... Sunday = 6)."""
    return (
        info.withColumn("SessionWeekDay", F.weekday("SessionDate"))
        .groupBy("SessionWeekDay")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.round(F.sum("SessionTimeLength") / 60).alias("TotalSessionTimeInHours"),
        )
        .orderBy(*_order("q_sessions_by_weekday"))
    )


def players_by_age_gender(info: DataFrame) -> DataFrame:
    return (
        info.groupBy("AgeBin", "Gender")
        .agg(_players(info).alias("Players"))
        .select("Players", "AgeBin", "Gender")
        .orderBy(*_order("q_players_by_age_gender"))
    )


# 2. Retention -----------------------------------------------------------------


def retention(summary: DataFrame, unique_ids: bool | None = None) -> DataFrame:
    """Established players split by IsActive, with each side's share (2 dp).

    Where a player has one row (known, or said by ``unique_ids``) the total is the
    sum of the sides, one pass; otherwise a scalar subquery counts it.
    """
    unique_ids = has_key(summary, "PlayerID") if unique_ids is None else unique_ids
    established, count = _established(summary), _players(summary, unique_ids)
    groups = established.groupBy("IsActive").agg(count.alias("Players"))
    shares = _with_share(groups, "share", lambda: established.agg(F.count_distinct("PlayerID")), unique_ids)
    return shares.select("Players", F.round("share", 2).alias("Percentage"), "IsActive")


def feature_mix(summary: DataFrame, unique_rows: bool | None = None) -> DataFrame:
    """Average platform diversity and the action mix of active established players.

    Equal rows count once. A table with a known key has none (``unique_rows``
    overrides that), so only the columns that the answer needs are read.
    """
    unique_rows = has_key(summary, *summary.columns) if unique_rows is None else unique_rows
    counts = list(ACTION_COUNT_COLUMNS.values())
    sums = [f"sum_{c}" for c in counts]
    chosen = _active_established(summary)
    totals = (chosen if unique_rows else distinct_rows(chosen)).agg(
        F.avg("PlatformDiversity").alias("AvgPlatformDiversity"),
        *[F.sum(c).alias(s) for c, s in zip(counts, sums)],
    )
    total_actions = sum((F.col(s) for s in sums[1:]), F.col(sums[0]))
    with_total = totals.withColumn("TotalActions", total_actions)
    return with_total.select(
        "*", *[safe_ratio(s, "TotalActions").alias(f"perc_{c}") for c, s in zip(counts, sums)]
    )


# 3. Revenue --------------------------------------------------------------------


def revenue_by_month(purchases: DataFrame) -> DataFrame:
    month = F.date_format(F.date_trunc("month", "PaymentTimestamp"), "yyyy-MM-01")
    return (
        purchases.withColumn("Month", month)
        .groupBy("Month")
        .agg(F.sum("ItemPrice").alias("Revenue"))
        .select("Revenue", "Month")
        .orderBy(*_order("q_revenue_by_month"))
    )


def engagement_spend(summary: DataFrame) -> DataFrame:
    """Per-player engagement and spend: the input of the correlation matrix."""
    return summary.select("PlayerID", *ENGAGEMENT_VARS, *SPEND_VARS)


def engagement_spend_correlation(summary: DataFrame) -> DataFrame:
    """Pearson correlation of each spend variable (rows) with each engagement one."""
    return correlation_matrix(summary, SPEND_VARS, ENGAGEMENT_VARS)


def revenue_by_item(purchases: DataFrame) -> DataFrame:
    return (
        purchases.groupBy("Item")
        .agg(F.sum("ItemPrice").alias("TotalRevenue"))
        .select("TotalRevenue", "Item")
        .orderBy(*_order("q_revenue_by_item"))
    )


def transactions_by_payment(purchases: DataFrame, unique_ids: bool | None = None) -> DataFrame:
    """Transactions per payment method (TransactionID is unique in the gold table)."""
    unique_ids = has_key(purchases, "TransactionID") if unique_ids is None else unique_ids
    return (
        purchases.groupBy("PaymentMethod")
        .agg(count_unique_key("TransactionID", unique_ids).alias("Transactions"))
        .select("Transactions", "PaymentMethod")
    )


def daily_totals(daily: DataFrame) -> DataFrame:
    """Per day over countries; AverageDailyItemPrice is a sum of per-country averages."""
    return (
        daily.groupBy("SessionDate")
        .agg(
            F.sum("UniqueTransactions").alias("UniqueTransactions"),
            F.sum("TotalDailyRevenue").alias("TotalDailyRevenue"),
            F.sum("AverageDailyItemPrice").alias("AverageDailyItemPrice"),
        )
        .orderBy(*_order("q_daily_totals"))
    )
