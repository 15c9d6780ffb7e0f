"""Commit log of a table folder: which data folders are the table, and how it came.

    <table>/versions/<id>/...       data, written before the commit that names it
    <table>/_commits/<12 digits>    one small JSON file for each commit

A commit states the whole table: format, schema, data folders, folders of quarantined
rows, what each stream has appended (``streams``) and proven facts. The highest number
is the table. A number is given once: the file is written under another name and then
renamed (on local disks: linked) without overwriting, so of two writers that take the
same number one fails. It reads the newer state and applies its change to that.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: A data folder that no commit names may belong to a writer that still runs.
ORPHAN_SECONDS = 86_400


@dataclass(frozen=True)
class State:
    """A table as one commit states it; folders are below ``versions``."""

    fmt: str
    schema: str
    folders: tuple[str, ...] = ()
    quarantine: tuple[str, ...] = ()
    streams: dict[str, dict] = field(default_factory=dict)
    facts: dict = field(default_factory=dict)
    info: dict = field(default_factory=dict)
    number: int = -1


def file_system(spark: SparkSession, path: str):
    """Hadoop's (file system, path), for any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def children(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, time of change in seconds) of what lies in a folder; none if it is missing."""
    fs, at = file_system(spark, path)
    return [(f.getPath().getName(), f.getModificationTime() / 1000) for f in fs.listStatus(at)] if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def _put(spark: SparkSession, path: str, content: str) -> bool:
    """The file at ``path`` if nothing is there: whole or not at all."""
    folder, _, name = path.rpartition("/")
    fs, whole = file_system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(whole, False)
    out.write(bytearray(content.encode()))
    out.close()
    local = fs.getScheme() == "file"
    try:
        if local:
            os.link(*[spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in (str(whole), path)])
        else:
            jvm = spark._jvm
            options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration()).rename(whole, jvm.org.apache.hadoop.fs.Path(path), options)
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception.getClass()):
            return False
        raise
    finally:
        fs.delete(whole, False)
    return True


def numbers(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the commits, oldest first."""
    return sorted(int(n) for n, _ in children(spark, f"{table}/_commits") if re.fullmatch(r"\d{12}", n))


def read(spark: SparkSession, table: str, number: int) -> State:
    fs, at = file_system(spark, f"{table}/_commits/{number:012d}")
    stream = fs.open(at)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return State(**found | {"folders": tuple(found["folders"]), "quarantine": tuple(found["quarantine"]), "number": number})


def latest(spark: SparkSession, table: str) -> State | None:
    """The table as it is now, or None if nothing was ever committed."""
    known = numbers(spark, table)
    return read(spark, table, known[-1]) if known else None


def commit(spark: SparkSession, table: str, change: Callable[[State | None], State | None]) -> State | None:
    """``change`` of the latest state as the next commit; None leaves the table as it is.

    If another writer takes the number first, ``change`` is asked again with what
    that writer committed.
    """
    while True:
        before = latest(spark, table)
        after = change(before)
        if after is None:
            return before
        after = replace(after, number=before.number + 1 if before else 0)
        if _put(spark, f"{table}/_commits/{after.number:012d}", json.dumps(asdict(after))):
            return after


def collect_old(spark: SparkSession, table: str, keep: int, retain_seconds: float, orphan_seconds: float = ORPHAN_SECONDS) -> None:
    """Remove commits beyond the newest ``keep`` and older than ``retain_seconds``, and data that none names.

    Data folders that no commit ever named go when they are older than ``orphan_seconds``.
    """
    now = time.time()
    commits = sorted((int(n), at) for n, at in children(spark, f"{table}/_commits") if re.fullmatch(r"\d{12}", n))
    old = [number for number, at in commits[:-keep] if now - at >= retain_seconds]
    if not old and len(commits) > 1:
        return
    states = {number: read(spark, table, number) for number, _ in commits}
    named = {number: {f.split("/")[0] for f in (*s.folders, *s.quarantine)} for number, s in states.items()}
    live = set().union(*[named[number] for number in named if number not in old])
    dead = set().union(*[named[number] for number in old]) - live
    for number in old:
        remove(spark, f"{table}/_commits/{number:012d}")
    for folder, at in children(spark, f"{table}/versions"):
        if folder in dead or (folder not in live and now - at >= orphan_seconds):
            remove(spark, f"{table}/versions/{folder}")
