"""Gold layer: denormalised fact tables and the pre-aggregated report tables.

Plan notes (what keeps these cheap at scale):

* The two denormalising joins are many-to-one (silver players are unique per
  PlayerID). No hint is given: AQE broadcasts the players side only when its
  *measured* size is under the adaptive broadcast threshold, and otherwise
  keeps a sort-merge join whose skewed partitions it splits.
* Every report is a ``groupBy`` whose aggregates are combined map-side before
  the shuffle, so a player or day that owns a third of the rows is reduced per
  task first. ``median``/``mode`` keep a value->count map per group, bounded by
  the number of distinct ages / platforms, not by the number of rows.
* The action counts are aggregated per player *before* the join to players:
  the explode is narrow, the partial aggregate shrinks it to one row per player
  per task, and the join then runs at player grain instead of session x action
  grain. Grouping by PlayerID and then joining the distinct (PlayerID, Country)
  pairs gives exactly the rows of join-then-group-by (PlayerID, Country).
* SessionID and TransactionID are unique keys of the denormalised tables (the
  silver dedup keeps one row per id, and the join to players is many-to-one),
  and a player has one row of attributes. These facts go with the frames
  (``playerlake.facts``): where an input has them, distinct counts become plain
  counts, and the statistics are built from hash aggregates in stages. Other
  inputs have their ids counted distinct. ``unique_ids`` overrides what is known.

``as_of`` pins "today" for AccountAgeDays and IsActive; it defaults to
``current_date()`` like a live job, tests pass a fixed date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playerlake.facts import determines, facts_of, has_key, with_facts
from playerlake.functions.codes import ACTION_COUNT_COLUMNS, PLATFORMS, UNKNOWN
from playerlake.functions.parse import as_date_col, safe_ratio
from playerlake.operators.aggregates import count_unique_key
from playerlake.operators.argmax import priority_argmax
from playerlake.operators.distinct import distinct_counts, join_groups

ACTIVE_WITHIN_DAYS = 15

AsOf = str | _dt.date | Column | None


def _with_attributes(facts: DataFrame, players: DataFrame, joined: DataFrame) -> DataFrame:
    """What a join to players proves: one row a player keeps the other side's key and settles the attributes."""
    if not has_key(players, "PlayerID"):
        return joined
    return with_facts(joined, facts_of(facts).key, {"PlayerID": [c for c in players.columns if c != "PlayerID"]})


def players_info(game_logs: DataFrame, players: DataFrame) -> DataFrame:
    """``gold_players_info``: one row per session with the player's attributes."""
    joined = game_logs.join(players, on="PlayerID", how="inner").withColumn(
        "SessionDate", F.to_date("LoginTime")
    )
    return _with_attributes(game_logs, players, joined)


def players_purchases(purchases: DataFrame, players: DataFrame) -> DataFrame:
    """``gold_players_purchases``: one row per transaction with player attributes.

    ``SessionDate`` here is the payment date.
    """
    joined = (
        purchases.join(players, on="PlayerID", how="inner")
        .withColumnRenamed("Timestamp", "PaymentTimestamp")
        .withColumn("SessionDate", F.to_date("PaymentTimestamp"))
    )
    return _with_attributes(purchases, players, joined)


def _known(unique_ids: bool | None, known: bool) -> bool:
    return known if unique_ids is None else unique_ids


def daily_session_metrics(info: DataFrame, unique_ids: bool | None = None) -> DataFrame:
    """Per (SessionDate, Country): players, sessions, minutes and age statistics.

    Age statistics are session-weighted (over session rows, not players).
    ``UniqueCountries`` counts the group's own Country, so it is 1, or 0 for the
    null-country group; it is computed from the key, which spares the
    distinct-aggregate rewrite one more copy of the input.
    """
    if _known(unique_ids, has_key(info, "SessionID") and determines(info, "PlayerID", "Country", "Age")):
        metrics = _daily_in_stages(info)
    else:
        day = ["SessionDate", "Country"]
        ids = distinct_counts(info, day, {"UniquePlayers": "PlayerID", "UniqueSessions": "SessionID"})
        statistics = info.groupBy(*day).agg(
            F.sum("SessionTimeLength").alias("TotalDailySessionLength"),
            F.avg("Age").alias("AvgPlayerAge"),
            F.median("Age").alias("MedianPlayerAge"),
            F.mode("Age", deterministic=True).alias("ModePlayerAge"),
            F.stddev("Age").alias("StandardDeviationPlayerAge"),
        )
        metrics = join_groups(ids, statistics, day)
    metrics = metrics.withColumn(
        "UniqueCountries",
        F.when(F.col("Country").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
    )
    return with_facts(metrics, ["SessionDate", "Country"])


def _daily_in_stages(info: DataFrame) -> DataFrame:
    """Day and country from day, country and age from day, country and player.

    Plain hash aggregates with one number a column. The median and the mode see
    one weighted row for each age; mean and deviation come from exact integer
    moments.
    """
    by_player = info.groupBy("SessionDate", "Country", "PlayerID", "Age").agg(
        F.count("SessionID").alias("sessions"), F.count(F.lit(1)).alias("rows"), F.sum("SessionTimeLength").alias("minutes")
    )
    by_age = by_player.groupBy("SessionDate", "Country", "Age").agg(
        F.count("PlayerID").alias("players"), F.sum("sessions").alias("sessions"), F.sum("rows").alias("rows"), F.sum("minutes").alias("minutes")
    )
    age, known = F.col("Age").cast("bigint"), F.col("Age").isNotNull()
    weight = F.when(known, F.col("rows"))
    n, total = F.sum(weight), F.sum(age * F.col("rows"))
    square = F.sum((age * age * F.col("rows")).cast("decimal(38,0)"))
    staged = by_age.groupBy("SessionDate", "Country").agg(
        F.sum("players").alias("UniquePlayers"),
        F.sum("sessions").alias("UniqueSessions"),
        F.sum("minutes").alias("TotalDailySessionLength"),
        n.alias("n"), total.alias("total"), square.alias("square"),
        F.percentile("Age", 0.5, F.coalesce(weight, F.lit(0))).alias("MedianPlayerAge"),
        F.max_by("Age", F.when(known, F.struct(F.col("rows"), -F.col("Age")))).alias("ModePlayerAge"),
    )
    spread = F.col("square") * F.col("n").cast("decimal(20,0)") - F.col("total").cast("decimal(19,0)") * F.col("total").cast("decimal(19,0)")
    deviation = F.when(F.col("n") > 1, F.sqrt(spread.cast("double") / F.col("n").cast("double") / (F.col("n") - 1).cast("double")))
    return staged.select(
        "SessionDate", "Country", "UniquePlayers", "UniqueSessions", "TotalDailySessionLength",
        F.try_divide(F.col("total").cast("double"), F.col("n").cast("double")).alias("AvgPlayerAge"),
        "MedianPlayerAge", "ModePlayerAge", deviation.alias("StandardDeviationPlayerAge"),
    )


def daily_purchase_metrics(purchases: DataFrame, unique_ids: bool | None = None) -> DataFrame:
    """Per (SessionDate, Country) of payment: transactions and revenue."""
    metrics = purchases.groupBy("SessionDate", "Country").agg(
        count_unique_key("TransactionID", _known(unique_ids, has_key(purchases, "TransactionID"))).alias("UniqueTransactions"),
        F.sum("ItemPrice").alias("TotalDailyRevenue"),
        F.avg("ItemPrice").alias("AverageDailyItemPrice"),
    )
    return with_facts(metrics, ["SessionDate", "Country"])


def daily_metrics(session_metrics: DataFrame, purchase_metrics: DataFrame) -> DataFrame:
    """``gold_daily_metrics``: days and countries that have both sessions and purchases."""
    both = session_metrics.join(purchase_metrics, on=["SessionDate", "Country"], how="inner")
    return with_facts(both, ["SessionDate", "Country"])


def _player_countries(players: DataFrame, unique_ids: bool | None) -> DataFrame:
    pairs = players.select("PlayerID", "Country")
    return pairs if _known(unique_ids, has_key(players, "PlayerID")) else pairs.distinct()


def actions_exploded(game_logs: DataFrame, players: DataFrame, unique_ids: bool | None = None) -> DataFrame:
    """One row per (session, action) of a known player: PlayerID, Country, Action."""
    pairs = _player_countries(players, unique_ids)
    return game_logs.join(pairs, on="PlayerID", how="inner").select(
        "PlayerID", "Country", F.explode("Actions").alias("Action")
    )


def _action_counts() -> list[Column]:
    return [
        F.count_if(F.col("Action") == F.lit(label)).alias(name)
        for label, name in ACTION_COUNT_COLUMNS.items()
    ]


def actions_summary(game_logs: DataFrame, players: DataFrame, unique_ids: bool | None = None) -> DataFrame:
    """Per (PlayerID, Country): count of each action and the favourite action.

    Players whose sessions carry no action at all are absent; players with only
    unknown actions have all-zero counts and favourite "PvP Battle".
    """
    per_player = (
        game_logs.select("PlayerID", F.explode("Actions").alias("Action"))
        .groupBy("PlayerID")
        .agg(*_action_counts())
    )
    pairs = _player_countries(players, unique_ids)
    counts = list(ACTION_COUNT_COLUMNS.values())
    summary = (
        per_player.join(pairs, on="PlayerID", how="inner")
        .select("PlayerID", "Country", *counts)
        .withColumn("FavoriteAction", priority_argmax(ACTION_COUNT_COLUMNS))
    )
    return with_facts(summary, ["PlayerID"] if has_key(players, "PlayerID") else ["PlayerID", "Country"])


def player_activity(info: DataFrame, as_of: AsOf = None, unique_ids: bool | None = None) -> DataFrame:
    """Per (PlayerID, Country): session counts, play time, recency and platforms."""
    today, player = as_date_col(as_of), ["PlayerID", "Country"]
    if _known(unique_ids, has_key(info, "SessionID")):
        activity = _activity_in_stages(info, today)
    else:
        ids = distinct_counts(info, player, {"TotalSessions": "SessionID", "days": "SessionDate", "PlatformDiversity": "Platform"})
        last_login = F.max("LoginTime")
        rest = info.groupBy(*player).agg(
            F.avg("SessionTimeLength").alias("AvgSessionLengthMinutes"),
            F.sum("SessionTimeLength").alias("TotalPlayTimeMinutes"),
            last_login.alias("LastLoginDate"),
            F.date_diff(today, F.min("AccountCreationDate")).alias("AccountAgeDays"),
            F.mode("Platform", deterministic=True).alias("PrimaryPlatform"),
            _recent(today, last_login).alias("IsActive"),
        )
        activity = join_groups(ids, rest, player).select(
            *player, "TotalSessions", "AvgSessionLengthMinutes", "TotalPlayTimeMinutes", "LastLoginDate",
            safe_ratio("TotalSessions", "days").alias("AvgSessionsPerDay"),
            "AccountAgeDays", "PrimaryPlatform", "PlatformDiversity", "IsActive",
        )
    return with_facts(activity, ["PlayerID"] if determines(info, "PlayerID", "Country") else player)


def _recent(today: Column, last_login: Column) -> Column:
    return F.coalesce(F.date_diff(today, last_login) <= ACTIVE_WITHIN_DAYS, F.lit(False))


def _activity_in_stages(info: DataFrame, today: Column) -> DataFrame:
    """Player days first, then players: hash aggregates of plain numbers only.

    The silver layer decodes platforms to the labels of one code table, so each
    label is counted in a column of its own; mode and diversity compare columns.
    """
    labels = sorted({*PLATFORMS.values(), UNKNOWN})
    by_day = info.groupBy("PlayerID", "Country", "SessionDate").agg(
        F.count("SessionID").alias("sessions"),
        F.count("SessionTimeLength").alias("timed"),
        F.sum("SessionTimeLength").alias("minutes"),
        F.max("LoginTime").alias("login"),
        F.min("AccountCreationDate").alias("created"),
        *[F.count_if(F.col("Platform") == label).alias(f"on{k}") for k, label in enumerate(labels)],
    )
    on = [F.col(f"on{k}") for k in range(len(labels))]
    players = by_day.groupBy("PlayerID", "Country").agg(
        F.sum("sessions").alias("TotalSessions"),
        F.count("SessionDate").alias("days"),
        F.sum("timed").alias("timed"),
        F.sum("minutes").alias("TotalPlayTimeMinutes"),
        F.max("login").alias("LastLoginDate"),
        F.min("created").alias("created"),
        *[F.sum(c).alias(f"on{k}") for k, c in enumerate(on)],
    )
    most = F.greatest(*on)
    primary = F.when(most > 0, F.coalesce(*[F.when(c == most, label) for c, label in zip(on, labels)]))
    return players.select(
        "PlayerID", "Country", "TotalSessions",
        safe_ratio("TotalPlayTimeMinutes", "timed").alias("AvgSessionLengthMinutes"),
        "TotalPlayTimeMinutes", "LastLoginDate",
        safe_ratio("TotalSessions", "days").alias("AvgSessionsPerDay"),
        F.date_diff(today, F.col("created")).alias("AccountAgeDays"),
        primary.alias("PrimaryPlatform"),
        sum((F.when(c > 0, 1).otherwise(0) for c in on), F.lit(0)).cast("bigint").alias("PlatformDiversity"),
        _recent(today, F.col("LastLoginDate")).alias("IsActive"),
    )


def player_engagement(
    info: DataFrame, action_summary: DataFrame, as_of: AsOf = None, unique_ids: bool | None = None
) -> DataFrame:
    """Activity aggregates joined with the action summary on (PlayerID, Country)."""
    return _joined_players(player_activity(info, as_of, unique_ids), action_summary)


def _joined_players(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row a player on both sides is one row a player."""
    joined = left.join(right, on=["PlayerID", "Country"], how="inner")
    one_row = has_key(left, "PlayerID") and has_key(right, "PlayerID", "Country") or has_key(right, "PlayerID") and has_key(left, "PlayerID", "Country")
    if one_row:
        return with_facts(joined, ["PlayerID"])
    return with_facts(joined, ["PlayerID", "Country"] if has_key(left, "PlayerID", "Country") and has_key(right, "PlayerID", "Country") else [])


def player_spend(purchases: DataFrame, unique_ids: bool | None = None) -> DataFrame:
    """Per (PlayerID, Country): spend, purchase count and first/last payment."""
    spend = purchases.groupBy("PlayerID", "Country").agg(
        F.sum("ItemPrice").alias("TotalSpent"),
        count_unique_key("TransactionID", _known(unique_ids, has_key(purchases, "TransactionID"))).alias("NumPurchases"),
        F.avg("ItemPrice").alias("AvgPurchaseValue"),
        F.min("PaymentTimestamp").alias("FirstPurchaseDate"),
        F.max("PaymentTimestamp").alias("LastPurchaseDate"),
    )
    return with_facts(spend, ["PlayerID"] if determines(purchases, "PlayerID", "Country") else ["PlayerID", "Country"])


def player_summary(engagement: DataFrame, spend: DataFrame) -> DataFrame:
    """``gold_player_summary``: players with sessions, actions *and* purchases."""
    return _joined_players(engagement, spend)


def build_gold(silver: dict[str, DataFrame], as_of: AsOf = None) -> dict[str, DataFrame]:
    """All gold frames from the three silver frames (lazily; nothing runs here).

    ``silver`` keys: ``game_logs``, ``players``, ``purchases``. Facts that the silver
    layer has proven are used.
    """
    logs, players, purchases = silver["game_logs"], silver["players"], silver["purchases"]
    info = players_info(logs, players)
    paid = players_purchases(purchases, players)
    engagement = player_engagement(info, actions_summary(logs, players), as_of)
    return {
        "gold_players_info": info,
        "gold_players_purchases": paid,
        "gold_daily_metrics": daily_metrics(daily_session_metrics(info), daily_purchase_metrics(paid)),
        "gold_player_summary": player_summary(engagement, player_spend(paid)),
    }
