"""What is proven about a table: its unique key and which columns a column determines.

A layer function that proves a fact attaches it to the frame that it returns: the
dedup of a silver table proves its key, a join to a table with a key keeps the other
side's key. The fact belongs to that frame alone. A frame derived from it has none
until another function proves one, so a fact can't outlive the operation that breaks
it. Written tables store their facts in their commit, and reading gives them back.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Facts:
    """``key``: columns that no two rows share; ``determines``: column -> columns with one value for each of its values."""

    key: tuple[str, ...] = ()
    determines: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def as_json(self) -> dict:
        return {"key": list(self.key), "determines": {c: list(of) for c, of in self.determines.items()}}

    @classmethod
    def from_json(cls, found: dict) -> Facts:
        return cls(tuple(found.get("key", ())), {c: tuple(of) for c, of in found.get("determines", {}).items()})


_FACTS: WeakKeyDictionary[DataFrame, Facts] = WeakKeyDictionary()


def with_facts(df: DataFrame, key: Iterable[str] = (), determines: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """The frame itself, with facts that the caller has proven."""
    _FACTS[df] = Facts(tuple(key), {c: tuple(of) for c, of in (determines or {}).items()})
    return df


def facts_of(df: DataFrame) -> Facts:
    return _FACTS.get(df, Facts())


def has_key(df: DataFrame, *columns: str) -> bool:
    """Whether the columns are known to hold a unique key."""
    key = facts_of(df).key
    return bool(key) and set(key) <= set(columns)


def determines(df: DataFrame, column: str, *others: str) -> bool:
    """Whether each of the others has one value for each value of the column."""
    return has_key(df, column) or set(others) <= set(facts_of(df).determines.get(column, ()))
