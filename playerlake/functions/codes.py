"""Domain code tables and the column expressions that decode them.

Every decode is a plain ``CASE WHEN`` built from a Python table, so it stays a
JVM expression inside whole-stage codegen and Catalyst folds it like any other
conditional; no map literal, no UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- Fixed values -----------------------------------------------------------
# Labels of the source systems' codes. They must equal the reference's text
# exactly, because gold tables and the analysis queries compare against them.
UNKNOWN = "Unknown"

PLATFORMS = {
    "1": "Personal Computer",
    "2": "PlayStation 5",
    "3": "Xbox Series X",
    "4": "Mobile",
}

ACTIONS = {
    "0": "PvP Battle",
    "1": "Dungeon Raid",
    "2": "Crafting",
    "3": "Exploration",
    "4": "Trading",
    "5": "Gathering",
    "6": "Questing / Story Progression",
    "7": "Social Interaction",
}

GENDERS = {
    "1": "Male",
    "2": "Female",
    "3": "Unspecified",
}

ITEMS = {
    "0": "Loot Box / Mystery Chest",
    "1": "Potion of Fortune",
    "2": "Enchantment Scroll",
    "3": "Revival Token",
    "4": "Teleportation Rune",
    "5": "Cosmetic Outfit Box",
    "6": "Mount Egg",
    "7": "Pet Summoning Stone",
    "8": "Crafting Material Bundle",
    "9": "Treasure Map Fragment",
    "10": "Skill Tome",
    "11": "Title Scroll",
    "12": "Upgrade Protection Charm",
    "13": "Event Token Pack",
    "14": "Premium Dye Pack",
}

PAYMENT_METHODS = {
    "1": "Credit Card",
    "2": "PayPal",
    "3": "GiftCard",
}

# Age bins: half-open [lower, upper) ranges; None means unbounded.
AGE_BINS = [
    (None, 15, "Under 15"),
    (15, 25, "15-24"),
    (25, 35, "25-34"),
    (35, 45, "35-44"),
    (45, 55, "45-54"),
    (55, 65, "55-64"),
    (65, None, "65+"),
]

# Gold column name per action label, in the fixed tie-break priority order used
# for the favourite action (earlier wins a tie).
ACTION_COUNT_COLUMNS = {
    "PvP Battle": "PvP_Battle_Count",
    "Dungeon Raid": "Dungeon_Raid_Count",
    "Crafting": "Crafting_Count",
    "Exploration": "Exploration_Count",
    "Trading": "Trading_Count",
    "Gathering": "Gathering_Count",
    "Questing / Story Progression": "Questing_Story_Progression_Count",
    "Social Interaction": "Social_Interaction_Count",
}
# ----------------------------------------------------------------------------


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def case_sql(ref: str, table: Mapping[str, str], default: str = UNKNOWN) -> str:
    """``CASE ref WHEN code THEN label ... ELSE default END`` as SQL text."""
    whens = " ".join(f"WHEN {_sql_str(k)} THEN {_sql_str(v)}" for k, v in table.items())
    return f"CASE {ref} {whens} ELSE {_sql_str(default)} END"


def decode(c: str | Column, table: Mapping[str, str], default: str = UNKNOWN) -> Column:
    """Map a code column to its label; unknown codes and nulls give ``default``.

    A column *name* is decoded with one SQL ``CASE`` expression (a single call
    into the JVM while planning); a ``Column`` gets the equivalent ``when`` chain.
    Both analyse to the same expression.
    """
    if isinstance(c, str):
        return F.expr(case_sql(_ident(c), table, default))
    expr = None
    for key, label in table.items():
        cond = c == F.lit(key)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def decode_array(c: str, table: Mapping[str, str], default: str = UNKNOWN) -> Column:
    """Decode every element of an array column (a null array stays null)."""
    return F.expr(f"transform({_ident(c)}, x -> {case_sql('x', table, default)})")


def _bin_conditions(ref, bins, ge, lt, both):
    for lower, upper, label in bins:
        if lower is None and upper is None:
            raise ValueError("a bin needs at least one bound")
        if lower is None:
            yield lt(ref, upper), label
        elif upper is None:
            yield ge(ref, lower), label
        else:
            yield both(ge(ref, lower), lt(ref, upper)), label


def bin_by(
    c: str | Column,
    bins: Sequence[tuple[float | None, float | None, str]] = AGE_BINS,
    default: str = UNKNOWN,
) -> Column:
    """Label a numeric column by half-open ``[lower, upper)`` bins (null -> ``default``).

    Like ``decode``: one SQL ``CASE`` for a column name, a ``when`` chain for a Column.
    """
    if isinstance(c, str):
        conds = _bin_conditions(
            _ident(c), bins,
            lambda r, v: f"{r} >= {v!r}", lambda r, v: f"{r} < {v!r}", lambda a, b: f"{a} AND {b}",
        )
        whens = " ".join(f"WHEN {cond} THEN {_sql_str(label)}" for cond, label in conds)
        return F.expr(f"CASE {whens} ELSE {_sql_str(default)} END")
    expr = None
    for cond, label in _bin_conditions(
        c, bins, lambda r, v: r >= F.lit(v), lambda r, v: r < F.lit(v), lambda a, b: a & b
    ):
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)
