"""Intermediate tables in the shared scratch folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from playerlake.session import scratch_dir
from playerlake.sources.tables import remove_folder

_OPEN: list[list[str]] = []


def saved(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """The frame written to the shared scratch folder and read back: lineage ends here."""
    path = scratch_dir(df.sparkSession, purpose)
    for folders in _OPEN:
        folders.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_folders() -> Iterator[list[str]]:
    """The folders that operators save inside the block, in order.

    An operator's result reads some of them when it runs. Once that is done the
    caller may give the list to ``remove_scratch``.
    """
    folders: list[str] = []
    _OPEN.append(folders)
    try:
        yield folders
    finally:
        _OPEN[:] = [other for other in _OPEN if other is not folders]


def remove_scratch(spark: SparkSession, folders: list[str]) -> None:
    for path in folders:
        remove_folder(spark, path)
