"""Independent DuckDB formulation of every registered query (the oracle).

The SQL is written the straightforward way, deliberately *not* mirroring the
Spark plans: dedup by ``row_number()``, join-then-explode-then-group for the
action counts, the favourite action as explicit pairwise comparisons, mode as
"smallest of the most frequent". A mismatch therefore points at a real
semantic difference, not at a shared mistake.

Doubles are rounded in the final projection with the same digits the Spark
wrapper uses (``ROUND_DIGITS``), so sums computed in a different order hash
equal. Both sides round through ``decimal(38, digits + 3)`` (half away from
zero), so an exact tie such as an average of cents over 32 rows rounds the same
way in both engines. Three guard digits absorb last-bit noise, and they keep
``value * 10^scale`` exact in DuckDB's double-to-decimal conversion (exact
below 2^53); a wider scale loses that for large sums. Timestamps are plain ``TIMESTAMP`` (UTC wall clock).
"""

from __future__ import annotations

from playerlake.clock import run_date

# --- Fixed values (must equal the pipeline's code tables) ---------------------
AS_OF = "DATE '2024-02-14'"

PLATFORMS = [("1", "Personal Computer"), ("2", "PlayStation 5"), ("3", "Xbox Series X"), ("4", "Mobile")]
ACTIONS = [
    ("0", "PvP Battle"), ("1", "Dungeon Raid"), ("2", "Crafting"), ("3", "Exploration"),
    ("4", "Trading"), ("5", "Gathering"), ("6", "Questing / Story Progression"),
    ("7", "Social Interaction"),
]
GENDERS = [("1", "Male"), ("2", "Female"), ("3", "Unspecified")]
ITEMS = [
    ("0", "Loot Box / Mystery Chest"), ("1", "Potion of Fortune"), ("2", "Enchantment Scroll"),
    ("3", "Revival Token"), ("4", "Teleportation Rune"), ("5", "Cosmetic Outfit Box"),
    ("6", "Mount Egg"), ("7", "Pet Summoning Stone"), ("8", "Crafting Material Bundle"),
    ("9", "Treasure Map Fragment"), ("10", "Skill Tome"), ("11", "Title Scroll"),
    ("12", "Upgrade Protection Charm"), ("13", "Event Token Pack"), ("14", "Premium Dye Pack"),
]
AGE_BINS = [(15, "Under 15"), (25, "15-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
OLDEST = "65+"
PAYMENT_METHODS = [("1", "Credit Card"), ("2", "PayPal"), ("3", "GiftCard")]
ACTION_COLUMNS = [
    ("PvP Battle", "PvP_Battle_Count"), ("Dungeon Raid", "Dungeon_Raid_Count"),
    ("Crafting", "Crafting_Count"), ("Exploration", "Exploration_Count"),
    ("Trading", "Trading_Count"), ("Gathering", "Gathering_Count"),
    ("Questing / Story Progression", "Questing_Story_Progression_Count"),
    ("Social Interaction", "Social_Interaction_Count"),
]

# Digits every double output column is rounded to before comparison.
ROUND_DIGITS = {
    "ItemPrice": 2,
    "TotalDailyRevenue": 2,
    "TotalSpent": 2,
    "Revenue": 2,
    "TotalRevenue": 2,
    "TotalDailySessionLength": 4,
    "TotalPlayTimeMinutes": 4,
}
DEFAULT_DIGITS = 6
# ------------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(col: str, table: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table)
    return f"CASE {col} {whens} ELSE 'Unknown' END"


def _dedup(table: str, key: str, others: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in others)
    return (
        f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) AS __rn FROM {table}) WHERE __rn = 1"
    )


def _age_bin(age: str) -> str:
    whens = " ".join(f"WHEN {age} < {upper} THEN {_q(label)}" for upper, label in AGE_BINS)
    return f"CASE {whens} WHEN {age} IS NOT NULL THEN {_q(OLDEST)} ELSE 'Unknown' END"


def _favorite() -> str:
    names = [c for _, c in ACTION_COLUMNS]
    whens = []
    for label, col in ACTION_COLUMNS[:-1]:
        conds = " AND ".join(f"{col} >= {other}" for other in names if other != col)
        whens.append(f"WHEN {conds} THEN {_q(label)}")
    return f"CASE {' '.join(whens)} ELSE {_q(ACTION_COLUMNS[-1][0])} END"


def _mode_smallest(source: str, keys: list[str], value: str, alias: str) -> str:
    """Per-key mode of ``value`` (nulls ignored), smallest value on a tie."""
    k = ", ".join(keys)
    return (
        f"SELECT {k}, min({value}) AS {alias} FROM ("
        f"SELECT {k}, {value}, count(*) AS n, max(count(*)) OVER (PARTITION BY {k}) AS mx "
        f"FROM {source} WHERE {value} IS NOT NULL GROUP BY {k}, {value}) WHERE n = mx GROUP BY {k}"
    )


def _daily_sessions(info: str, mode: str) -> str:
    return f"""
SELECT g.SessionDate, g.Country,
       COUNT(DISTINCT g.PlayerID) AS UniquePlayers,
       COUNT(DISTINCT g.SessionID) AS UniqueSessions,
       SUM(g.SessionTimeLength) AS TotalDailySessionLength,
       AVG(g.Age) AS AvgPlayerAge,
       quantile_cont(g.Age, 0.5) AS MedianPlayerAge,
       any_value(m.ModePlayerAge) AS ModePlayerAge,
       stddev_samp(g.Age) AS StandardDeviationPlayerAge,
       CAST(COUNT(DISTINCT g.Country) AS BIGINT) AS UniqueCountries
FROM {info} g
LEFT JOIN {mode} m ON g.SessionDate IS NOT DISTINCT FROM m.SessionDate
                    AND g.Country IS NOT DISTINCT FROM m.Country
GROUP BY g.SessionDate, g.Country"""


def _activity(info: str, mode: str, today: str) -> str:
    return f"""
SELECT g.PlayerID, g.Country,
       COUNT(DISTINCT g.SessionID) AS TotalSessions,
       AVG(g.SessionTimeLength) AS AvgSessionLengthMinutes,
       SUM(g.SessionTimeLength) AS TotalPlayTimeMinutes,
       MAX(g.LoginTime) AS LastLoginDate,
       COUNT(DISTINCT g.SessionID) / NULLIF(COUNT(DISTINCT g.SessionDate), 0) AS AvgSessionsPerDay,
       CAST(date_diff('day', MIN(g.AccountCreationDate), {today}) AS INTEGER) AS AccountAgeDays,
       any_value(m.PrimaryPlatform) AS PrimaryPlatform,
       COUNT(DISTINCT g.Platform) AS PlatformDiversity,
       COALESCE(date_diff('day', CAST(MAX(g.LoginTime) AS DATE), {today}) <= 15, FALSE) AS IsActive
FROM {info} g
LEFT JOIN {mode} m ON g.PlayerID IS NOT DISTINCT FROM m.PlayerID
                         AND g.Country IS NOT DISTINCT FROM m.Country
GROUP BY g.PlayerID, g.Country"""


# Layer CTEs, each as (name, sql). Later ones refer to earlier ones by name.
_CTES: list[tuple[str, str]] = [
    ("bronze_players", """
SELECT 'P'||lpad(CAST(c_custkey AS VARCHAR),CAST(greatest(6,length(CAST(c_custkey AS VARCHAR))) AS INT),'0') AS plid, n_name AS country,
       CAST(8+(c_custkey*7)%65 AS VARCHAR) AS age,
       strftime(DATE '2024-02-14' - CAST((c_custkey*13)%400 AS INT),'%Y-%m-%d') AS acc_creat_date,
       CAST(c_custkey%4 AS VARCHAR) AS gender
FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    ("bronze_game_logs", """
SELECT 'P'||lpad(CAST(user_id AS VARCHAR),CAST(greatest(6,length(CAST(user_id AS VARCHAR))) AS INT),'0') AS _player_id,
       'S'||lpad(CAST(event_id AS VARCHAR),CAST(greatest(7,length(CAST(event_id AS VARCHAR))) AS INT),'0') AS _session_id,
       strftime(ts,'%Y-%m-%dT%H:%M:%S') AS _login,
       strftime(ts + to_seconds(CAST(floor(value*60) AS BIGINT)),'%Y-%m-%dT%H:%M:%S') AS _logout,
       [CAST(k%9 AS VARCHAR), CAST((k//9)%9 AS VARCHAR), CAST(event_id%8 AS VARCHAR)] AS _action,
       CAST(event_id%5 AS VARCHAR) AS _platform
FROM (SELECT *, TRY_CAST(regexp_extract(props,'[0-9]+') AS BIGINT) AS k FROM events)"""),
    ("bronze_purchases", """
SELECT 'T'||lpad(CAST(l_orderkey*10+l_linenumber AS VARCHAR),CAST(greatest(9,length(CAST(l_orderkey*10+l_linenumber AS VARCHAR))) AS INT),'0') AS transaction_id,
       'P'||lpad(CAST(o_custkey AS VARCHAR),CAST(greatest(6,length(CAST(o_custkey AS VARCHAR))) AS INT),'0') AS player_id,
       CAST(l_partkey%16 AS VARCHAR) AS item,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS item_price,
       CAST(l_linenumber%4 AS VARCHAR) AS pmethod,
       strftime(TIMESTAMP '2023-11-16'
                + to_seconds((l_orderkey*7919+l_linenumber*131)%7776000),'%Y-%m-%dT%H:%M:%S') AS "time"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    ("silver_game_logs", f"""
SELECT _player_id AS PlayerID, _session_id AS SessionID,
       TRY_CAST(_login AS TIMESTAMP) AS LoginTime,
       TRY_CAST(_logout AS TIMESTAMP) AS LogoutTime,
       list_transform(_action, lambda x: {_case('x', ACTIONS)}) AS Actions,
       {_case('_platform', PLATFORMS)} AS Platform,
       CAST(epoch(TRY_CAST(_logout AS TIMESTAMP)) - epoch(TRY_CAST(_login AS TIMESTAMP)) AS DOUBLE) / 60.0
           AS SessionTimeLength
FROM ({_dedup('bronze_game_logs', '_session_id', ['_player_id', '_login', '_logout', '_action', '_platform'])})"""),
    ("silver_players", f"""
SELECT plid AS PlayerID, country AS Country, TRY_CAST(age AS INTEGER) AS Age,
       TRY_CAST(acc_creat_date AS DATE) AS AccountCreationDate,
       {_case('gender', GENDERS)} AS Gender,
       {_age_bin('TRY_CAST(age AS INTEGER)')} AS AgeBin
FROM ({_dedup('bronze_players', 'plid', ['country', 'age', 'acc_creat_date', 'gender'])})"""),
    ("silver_purchases", f"""
SELECT transaction_id AS TransactionID, player_id AS PlayerID,
       {_case('item', ITEMS)} AS Item,
       TRY_CAST(item_price AS DOUBLE) AS ItemPrice,
       {_case('pmethod', PAYMENT_METHODS)} AS PaymentMethod,
       TRY_CAST("time" AS TIMESTAMP) AS "Timestamp"
FROM ({_dedup('bronze_purchases', 'transaction_id', ['player_id', 'item', 'item_price', 'pmethod', '"time"'])})"""),
    ("gold_players_info", """
SELECT l.PlayerID, l.SessionID, l.LoginTime, l.LogoutTime, l.Actions, l.Platform, l.SessionTimeLength,
       p.Country, p.Age, p.AccountCreationDate, p.Gender, p.AgeBin, CAST(l.LoginTime AS DATE) AS SessionDate
FROM silver_game_logs l JOIN silver_players p ON l.PlayerID = p.PlayerID"""),
    ("gold_players_purchases", """
SELECT t.PlayerID, t.TransactionID, t.Item, t.ItemPrice, t.PaymentMethod, t."Timestamp" AS PaymentTimestamp,
       p.Country, p.Age, p.AccountCreationDate, p.Gender, p.AgeBin, CAST(t."Timestamp" AS DATE) AS SessionDate
FROM silver_purchases t JOIN silver_players p ON t.PlayerID = p.PlayerID"""),
    ("info_by_action", "SELECT *, unnest(Actions) AS Action FROM gold_players_info"),
    ("paid_twice", "SELECT * FROM gold_players_purchases UNION ALL SELECT * FROM gold_players_purchases WHERE PaymentMethod = 'Credit Card'"),
    ("mode_age", _mode_smallest("gold_players_info", ["SessionDate", "Country"], "Age", "ModePlayerAge")),
    ("daily_session_metrics", _daily_sessions("gold_players_info", "mode_age")),
    ("mode_age_general", _mode_smallest("info_by_action", ["SessionDate", "Country"], "Age", "ModePlayerAge")),
    ("daily_session_metrics_general", _daily_sessions("info_by_action", "mode_age_general")),
    ("daily_purchase_metrics", """
SELECT SessionDate, Country,
       COUNT(DISTINCT TransactionID) AS UniqueTransactions,
       SUM(ItemPrice) AS TotalDailyRevenue,
       AVG(ItemPrice) AS AverageDailyItemPrice
FROM gold_players_purchases GROUP BY SessionDate, Country"""),
    ("daily_purchase_metrics_general", """
SELECT SessionDate, Country,
       COUNT(DISTINCT TransactionID) AS UniqueTransactions,
       SUM(ItemPrice) AS TotalDailyRevenue,
       AVG(ItemPrice) AS AverageDailyItemPrice
FROM paid_twice GROUP BY SessionDate, Country"""),
    ("gold_daily_metrics", """
SELECT s.*, p.UniqueTransactions, p.TotalDailyRevenue, p.AverageDailyItemPrice
FROM daily_session_metrics s JOIN daily_purchase_metrics p
  ON s.SessionDate = p.SessionDate AND s.Country = p.Country"""),
    ("actions_exploded", """
SELECT l.PlayerID, p.Country, unnest(l.Actions) AS Action
FROM silver_game_logs l JOIN (SELECT DISTINCT PlayerID, Country FROM silver_players) p
  ON l.PlayerID = p.PlayerID"""),
    ("action_counts", "SELECT PlayerID, Country, "
     + ", ".join(f"CAST(SUM(CASE WHEN Action = {_q(label)} THEN 1 ELSE 0 END) AS BIGINT) AS {col}"
                 for label, col in ACTION_COLUMNS)
     + " FROM actions_exploded GROUP BY PlayerID, Country"),
    ("actions_summary", f"SELECT *, {_favorite()} AS FavoriteAction FROM action_counts"),
    ("mode_platform", _mode_smallest("gold_players_info", ["PlayerID", "Country"], "Platform", "PrimaryPlatform")),
    ("player_activity", _activity("gold_players_info", "mode_platform", AS_OF)),
    ("mode_platform_general", _mode_smallest("info_by_action", ["PlayerID", "Country"], "Platform", "PrimaryPlatform")),
    ("player_activity_general", _activity("info_by_action", "mode_platform_general", AS_OF)),
    ("player_activity_today", _activity("gold_players_info", "mode_platform", f"DATE '{run_date()}'")),
    ("player_engagement", """
SELECT a.*, s.* EXCLUDE (PlayerID, Country)
FROM player_activity a JOIN actions_summary s ON a.PlayerID = s.PlayerID AND a.Country = s.Country"""),
    ("player_engagement_today", """
SELECT a.*, s.* EXCLUDE (PlayerID, Country)
FROM player_activity_today a JOIN actions_summary s ON a.PlayerID = s.PlayerID AND a.Country = s.Country"""),
    ("player_spend", """
SELECT PlayerID, Country,
       SUM(ItemPrice) AS TotalSpent,
       COUNT(DISTINCT TransactionID) AS NumPurchases,
       AVG(ItemPrice) AS AvgPurchaseValue,
       MIN(PaymentTimestamp) AS FirstPurchaseDate,
       MAX(PaymentTimestamp) AS LastPurchaseDate
FROM gold_players_purchases GROUP BY PlayerID, Country"""),
    ("player_spend_general", """
SELECT PlayerID, Country,
       SUM(ItemPrice) AS TotalSpent,
       COUNT(DISTINCT TransactionID) AS NumPurchases,
       AVG(ItemPrice) AS AvgPurchaseValue,
       MIN(PaymentTimestamp) AS FirstPurchaseDate,
       MAX(PaymentTimestamp) AS LastPurchaseDate
FROM paid_twice GROUP BY PlayerID, Country"""),
    ("gold_player_summary", """
SELECT e.*, s.* EXCLUDE (PlayerID, Country)
FROM player_engagement e JOIN player_spend s ON e.PlayerID = s.PlayerID AND e.Country = s.Country"""),
    ("summary_twice", "SELECT * FROM gold_player_summary UNION ALL SELECT * FROM gold_player_summary WHERE PrimaryPlatform = 'Mobile'"),
]

_CTE_NAMES = [name for name, _ in _CTES]

# Analysis queries. Row order is not part of the comparison, so no ORDER BY.
_ANALYSIS: dict[str, str] = {
    "q_total_players": "SELECT count(DISTINCT PlayerID) AS Players FROM silver_players",
    "q_active_players": "SELECT count(DISTINCT PlayerID) AS ActivePlayers FROM gold_player_summary "
                        "WHERE IsActive AND AccountAgeDays > 15",
    "q_new_players": "SELECT count(DISTINCT PlayerID) AS NewPlayers FROM gold_player_summary "
                     "WHERE AccountAgeDays <= 15",
    "q_players_by_country": """
SELECT Country, Players, Players / (SELECT count(DISTINCT PlayerID) FROM silver_players) AS PercPlayers
FROM (SELECT Country, count(DISTINCT PlayerID) AS Players FROM silver_players GROUP BY Country)""",
    "q_hours_by_action": """
SELECT FavoriteAction, round(sum(TotalPlayTimeMinutes) / 60) AS HoursPlayed
FROM gold_player_summary GROUP BY 1""",
    "q_hours_by_platform": """
SELECT PrimaryPlatform, round(sum(TotalPlayTimeMinutes) / 60) AS HoursPlayed
FROM gold_player_summary GROUP BY 1""",
    "q_sessions_by_weekday": """
SELECT CAST(isodow(SessionDate) - 1 AS INTEGER) AS SessionWeekDay, count(*) AS sessions,
       round(sum(SessionTimeLength) / 60) AS TotalSessionTimeInHours
FROM gold_players_info GROUP BY 1""",
    "q_players_by_age_gender": """
SELECT count(DISTINCT PlayerID) AS Players, AgeBin, Gender FROM gold_players_info GROUP BY 2, 3""",
    "q_retention": """
SELECT Players,
       round(Players / (SELECT count(DISTINCT PlayerID) FROM gold_player_summary WHERE AccountAgeDays > 15), 2)
         AS Percentage,
       IsActive
FROM (SELECT IsActive, count(DISTINCT PlayerID) AS Players
      FROM gold_player_summary WHERE AccountAgeDays > 15 GROUP BY 1)""",
    "q_feature_mix": "SELECT *, "
    + ", ".join(f"sum_{c} / TotalActions AS perc_{c}" for _, c in ACTION_COLUMNS)
    + " FROM (SELECT *, " + " + ".join(f"sum_{c}" for _, c in ACTION_COLUMNS) + " AS TotalActions FROM ("
    + "SELECT avg(PlatformDiversity) AS AvgPlatformDiversity, "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS sum_{c}" for _, c in ACTION_COLUMNS)
    + " FROM (SELECT DISTINCT * FROM gold_player_summary WHERE IsActive AND AccountAgeDays > 15)))",
    "q_revenue_by_month": """
SELECT sum(ItemPrice) AS Revenue, strftime(date_trunc('month', PaymentTimestamp), '%Y-%m-01') AS Month
FROM gold_players_purchases GROUP BY 2""",
    "q_engagement_spend": """
SELECT PlayerID, TotalSessions, AvgSessionLengthMinutes, TotalPlayTimeMinutes, TotalSpent, AvgPurchaseValue
FROM gold_player_summary""",
    "q_revenue_by_item": "SELECT sum(ItemPrice) AS TotalRevenue, Item FROM gold_players_purchases GROUP BY 2",
    "q_transactions_by_payment": """
SELECT count(DISTINCT TransactionID) AS Transactions, PaymentMethod FROM gold_players_purchases GROUP BY 2""",
    "q_daily_totals": """
SELECT SessionDate, CAST(sum(UniqueTransactions) AS BIGINT) AS UniqueTransactions,
       sum(TotalDailyRevenue) AS TotalDailyRevenue, sum(AverageDailyItemPrice) AS AverageDailyItemPrice
FROM gold_daily_metrics GROUP BY 1""",
    "engagement_spend_correlation": " UNION ALL ".join(
        f"SELECT {_q(r)} AS RowVariable, {_q(c)} AS ColumnVariable, corr({r}, {c}) AS Correlation "
        f"FROM gold_player_summary"
        for r in ["TotalSpent", "AvgPurchaseValue"]
        for c in ["TotalSessions", "AvgSessionLengthMinutes", "TotalPlayTimeMinutes"]
    ),
}

# The same questions over tables with repeated ids or rows.
_GENERAL = {
    "q_feature_mix_general": ("q_feature_mix", "gold_player_summary", "summary_twice"),
    "q_retention_general": ("q_retention", "gold_player_summary", "summary_twice"),
    "q_players_by_country_general": ("q_players_by_country", "silver_players", "info_by_action"),
}
_ANALYSIS |= {name: _ANALYSIS[of].replace(table, other) for name, (of, table, other) in _GENERAL.items()}

# Sorted questions: the order asked for, then what decides ties (nulls as Spark sorts them).
_POSITIONS = {
    "q_players_by_country": "Players DESC NULLS LAST, Country ASC NULLS FIRST",
    "q_hours_by_action": "HoursPlayed DESC NULLS LAST, FavoriteAction ASC NULLS FIRST",
    "q_hours_by_platform": "HoursPlayed DESC NULLS LAST, PrimaryPlatform ASC NULLS FIRST",
    "q_sessions_by_weekday": "SessionWeekDay ASC NULLS FIRST",
    "q_players_by_age_gender": "AgeBin ASC NULLS FIRST, Gender ASC NULLS FIRST",
    "q_revenue_by_month": '"Month" ASC NULLS FIRST',
    "q_revenue_by_item": "TotalRevenue DESC NULLS LAST, Item ASC NULLS FIRST",
    "q_daily_totals": "SessionDate ASC NULLS FIRST",
}
_ANALYSIS |= {
    f"{name}_ordered": f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position FROM ({_ANALYSIS[name].strip()})"
    for name, order in _POSITIONS.items()
}

# Double output columns per query (rounded before comparison).
_DOUBLES = {
    "silver_game_logs": ["SessionTimeLength"],
    "silver_purchases": ["ItemPrice"],
    "gold_players_info": ["SessionTimeLength"],
    "gold_players_purchases": ["ItemPrice"],
    "daily_session_metrics": ["TotalDailySessionLength", "AvgPlayerAge", "MedianPlayerAge",
                              "StandardDeviationPlayerAge"],
    "daily_purchase_metrics": ["TotalDailyRevenue", "AverageDailyItemPrice"],
    "player_spend": ["TotalSpent", "AvgPurchaseValue"],
    "q_players_by_country": ["PercPlayers"],
    "q_hours_by_action": ["HoursPlayed"],
    "q_hours_by_platform": ["HoursPlayed"],
    "q_sessions_by_weekday": ["TotalSessionTimeInHours"],
    "q_retention": ["Percentage"],
    "q_feature_mix": ["AvgPlatformDiversity"] + [f"perc_{c}" for _, c in ACTION_COLUMNS],
    "q_revenue_by_month": ["Revenue"],
    "q_revenue_by_item": ["TotalRevenue"],
    "q_daily_totals": ["TotalDailyRevenue", "AverageDailyItemPrice"],
    "engagement_spend_correlation": ["Correlation"],
}
_ACTIVITY_DOUBLES = ["AvgSessionLengthMinutes", "TotalPlayTimeMinutes", "AvgSessionsPerDay"]
_DOUBLES["gold_daily_metrics"] = _DOUBLES["daily_session_metrics"] + _DOUBLES["daily_purchase_metrics"]
_DOUBLES["player_engagement"] = _ACTIVITY_DOUBLES
_DOUBLES["gold_player_summary"] = _ACTIVITY_DOUBLES + _DOUBLES["player_spend"]
_DOUBLES["q_engagement_spend"] = ["AvgSessionLengthMinutes", "TotalPlayTimeMinutes", "TotalSpent",
                                  "AvgPurchaseValue"]
_DOUBLES["daily_session_metrics_general"] = _DOUBLES["daily_session_metrics"]
_DOUBLES["daily_purchase_metrics_general"] = _DOUBLES["daily_purchase_metrics"]
_DOUBLES["player_spend_general"] = _DOUBLES["player_spend"]
_DOUBLES["player_activity_general"] = _DOUBLES["player_engagement_today"] = _ACTIVITY_DOUBLES
_DOUBLES |= {name: _DOUBLES.get(of, []) for name, (of, _, _) in _GENERAL.items()}
_DOUBLES |= {f"{name}_ordered": _DOUBLES.get(name, []) for name in _POSITIONS}


def digits(column: str) -> int:
    return ROUND_DIGITS.get(column, DEFAULT_DIGITS)


def _needed(body: str, upto: int) -> list[tuple[str, str]]:
    """The CTEs (in order) that ``body`` depends on, transitively."""
    import re

    need: set[str] = set()
    frontier = [body]
    while frontier:
        text = frontier.pop()
        for name, sql in _CTES[:upto]:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                frontier.append(sql)
    return [(n, s) for n, s in _CTES[:upto] if n in need]


def _with(body: str, upto: int) -> str:
    ctes = _needed(body, upto)
    if not ctes:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({s.strip()})" for n, s in ctes) + "\n" + body.strip()


def _rounded(name: str, sql: str) -> str:
    cols = _DOUBLES.get(name, [])
    if not cols:
        return sql
    repl = ", ".join(
        f"CAST(round(TRY_CAST({c} AS DECIMAL(38,{digits(c) + 3})), {digits(c)}) AS DOUBLE) AS {c}"
        for c in cols
    )
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n)"


def oracle_queries() -> dict[str, str]:
    """Query name -> DuckDB SQL over the driver tables."""
    out: dict[str, str] = {}
    for i, (name, _) in enumerate(_CTES):
        if name in {"mode_age", "mode_platform", "action_counts", "player_activity", "player_activity_today", "info_by_action", "paid_twice", "summary_twice", "mode_age_general", "mode_platform_general"}:
            continue
        out[name] = _rounded(name, _with(f"SELECT * FROM {name}", i + 1))
    for name, body in _ANALYSIS.items():
        out[name] = _rounded(name, _with(body, len(_CTES)))
    # the same questions asked in SQL, and tables written and read back
    asked = [name for name in _ANALYSIS if not name.endswith(("_general", "_ordered"))]
    out |= {f"{name}_sql": out[name] for name in asked}
    out |= {f"table_{name}": out[name] for name in ("silver_game_logs", "gold_player_summary")}
    return out
