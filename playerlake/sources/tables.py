"""Batch table access: driver parquet scans, table reads and restart-safe refreshes.

Layer hand-offs go through written tables. That cuts the lineage between
layers (an executor lost in the gold stage recomputes from silver files, not
from raw text), and it is how the layers are shared with BI readers.

A full refresh never touches the rows that readers see: they go to a new data folder
first, and one commit (``commits``) then makes it the table, whatever its schema. A
job killed before the commit leaves the old table as it was.

* A path table is a folder with ``versions/`` and ``_commits/``.
* A catalog table is a view over the data folders of such a folder, which lies below
  the database's location. ``CREATE OR REPLACE VIEW`` changes rows and schema in one
  step of the catalog, and nothing is ever dropped. A job killed between commit and
  view leaves the view on the version before, which is kept.
* Delta tables have atomic overwrites of their own.

Two writers may refresh one table: both commits stand, one after the other, and
``expect`` makes the later one fail instead. A refresh removes the versions before the
last one (``keep``, ``retain_seconds``), so years of refreshes keep two copies.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from playerlake.facts import Facts, facts_of, with_facts
from playerlake.sources import commits
from playerlake.sources.commits import State

DEFAULT_FORMAT = "parquet"

#: Versions that a refresh leaves: the current one and the one that running readers may scan.
KEEP_VERSIONS = 2


class RefreshConflict(RuntimeError):
    """Another writer has changed the table since the expected commit."""


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``); columns are pruned lazily."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def file_stamp(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files at a path: equal stamps, equal files."""
    fs, at = commits.file_system(spark, path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(at)))


def remove_folder(spark: SparkSession, path: str) -> None:
    commits.remove(spark, path)


def table_folder(spark: SparkSession, name: str, root: str | None = None) -> str:
    """The folder of a table: the path itself, or a folder below the database's location (or ``root``)."""
    if "/" in name:
        return name.rstrip("/")
    database, _, table = name.rpartition(".")
    root = root or spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/_versions/{table}"


def _scan(spark: SparkSession, folder: str, state: State, parts: tuple[str, ...], schema: StructType) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.format(state.fmt).schema(schema).load([f"{folder}/versions/{p}" for p in parts])


def _schema(state: State) -> StructType:
    return StructType.fromJson(json.loads(state.schema))


def current_state(spark: SparkSession, name: str, root: str | None = None) -> State | None:
    """What the last commit says of a table: number, ledger of streams, facts and notes."""
    return commits.latest(spark, table_folder(spark, name, root))


def read_table(spark: SparkSession, name: str, fmt: str = DEFAULT_FORMAT, root: str | None = None) -> DataFrame:
    """A table as its last commit states it, with its facts; else a catalog table or folder of any kind."""
    folder = table_folder(spark, name, root)
    state = commits.latest(spark, folder) if fmt != "delta" else None
    if state is None:
        return spark.read.format(fmt).load(name) if "/" in name else spark.read.table(name)
    known = Facts.from_json(state.facts)
    return with_facts(_scan(spark, folder, state, state.folders, _schema(state)), known.key, known.determines)


def _point_view(spark: SparkSession, name: str, folder: str, state: State) -> None:
    """The catalog's name over the state's data folders, in one step."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table that this library did not write; rename it first")
    parts, schema = state.folders, _schema(state)
    if parts:
        at = f"{folder}/versions/" + (parts[0] if len(parts) == 1 else "{" + ",".join(parts) + "}")
        rows = ", ".join(f"`{c}`" for c in schema.names) + f" FROM {state.fmt}.`{at}`"
    else:
        rows = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields) + " WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {rows}")


def point_catalog(spark: SparkSession, name: str, root: str | None = None) -> None:
    """Bring a catalog table's view to the last commit (nothing to do for a path)."""
    folder = table_folder(spark, name, root)
    if "/" not in name and (state := commits.latest(spark, folder)):
        _point_view(spark, name, folder, state)


def write_table(df: DataFrame, name: str, fmt: str = DEFAULT_FORMAT, root: str | None = None, *, info: dict | None = None,
                expect: int | None = None, keep: int = KEEP_VERSIONS, retain_seconds: float = 0) -> DataFrame:
    """Full refresh with schema replace, then return a scan of what was written.

    ``name`` is a catalog table name or a path. A catalog table's versions lie
    below ``root``, by default the folder of its database. ``info`` is stored with
    the commit. With ``expect``, the number of the commit that the rows were made
    from, a table that has changed since raises ``RefreshConflict``.
    """
    spark = df.sparkSession
    if fmt == "delta":
        writer = df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true")
        writer.save(name) if "/" in name else writer.saveAsTable(name)
        return read_table(spark, name, fmt)
    folder, version = table_folder(spark, name, root), uuid.uuid4().hex
    df.write.format(fmt).save(f"{folder}/versions/{version}")

    def change(before: State | None) -> State:
        if expect is not None and expect != (before.number if before else -1):
            raise RefreshConflict(f"{name} is at commit {before.number if before else None}, not {expect}")
        return State(fmt, df.schema.json(), (version,), streams=before.streams if before else {}, facts=facts_of(df).as_json(),
                     info={"time": time.time(), **(info or {})})

    state = commits.commit(spark, folder, change)
    if "/" not in name:
        _point_view(spark, name, folder, state)
    commits.collect_old(spark, folder, keep, retain_seconds)
    return read_table(spark, name, fmt, root)


def compact_table(spark: SparkSession, name: str, root: str | None = None, keep: int = KEEP_VERSIONS) -> None:
    """Rewrite the data folders that streams have appended as one; what is appended meanwhile stays.

    The ledger of the streams and the quarantine are left as they are.
    """
    folder = table_folder(spark, name, root)
    found = commits.latest(spark, folder)
    if found is None or len(found.folders) < 2:
        return
    version = uuid.uuid4().hex
    _scan(spark, folder, found, found.folders, _schema(found)).write.format(found.fmt).save(f"{folder}/versions/{version}")

    def change(now: State | None) -> State:
        if now is None or now.folders[: len(found.folders)] != found.folders:
            raise RefreshConflict(f"{name} was refreshed while it was compacted")
        return replace(now, folders=(version, *now.folders[len(found.folders):]))

    commits.commit(spark, folder, change)
    point_catalog(spark, name, root)
    commits.collect_old(spark, folder, keep, 0)


def read_quarantine(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """The raw records of a table that could not be read: text, file and what was read of them."""
    folder = table_folder(spark, name, root)
    state = commits.latest(spark, folder)
    if state is None or "quarantine" not in state.info:
        raise ValueError(f"{name} is not a table that a stream feeds")
    return _scan(spark, folder, state, state.quarantine, StructType.fromJson(state.info["quarantine"]))
