"""Incremental file ingest: raw JSON/CSV landing folder -> all-string bronze table.

A Structured Streaming file source with a declared schema, run with
``Trigger.AvailableNow``: each call picks up every file not yet recorded in the
checkpoint, in micro-batches of at most ``max_files_per_trigger`` files, commits
and stops. Re-running with the same checkpoint adds nothing; a new file adds only its
own rows.

Every micro-batch is one commit of the table (``sources.commits``), which also holds
the ledger of the stream: its last batch and what all its batches added. A batch that
Spark replays, because a job was killed after the table's commit and before the
checkpoint's, finds its number in the ledger and adds nothing. What a run reports is
the difference of the ledger, so it can't be lost.

Records that do not fit the declared schema (a broken JSON line, a CSV line with too
few or too many fields) do not become rows of nulls: they go to the table's
quarantine, with their text and file, and are counted (``read_quarantine``).

The call blocks until the stream is done, so the next layer never reads a half-written
bronze table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from playerlake.sources import commits
from playerlake.sources.commits import State
from playerlake.sources.schemas import SOURCES
from playerlake.sources.tables import current_state, point_catalog, table_folder


#: Files of one micro-batch: one commit and one unit of retry.
MAX_FILES_PER_TRIGGER = 1000

#: Columns of the quarantine besides what was read of a record.
RAW_RECORD = "_corrupt_record"
RAW_FILE = "_raw_file"
BROKEN = "broken"

NOTHING = {"batch": -1, "batches": 0, "rows": 0, "quarantined": 0}


@dataclass(frozen=True)
class IngestResult:
    """What one run appended: rows, non-empty micro-batches, and records put into quarantine."""

    target: str
    batches: int
    rows: int
    quarantined: int = 0


def read_stream(spark: SparkSession, fmt: str, source_dir: str, schema: StructType,
                options: dict[str, str] | None = None,
                max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
                archive_dir: str | None = None) -> DataFrame:
    """Streaming scan of a landing folder with a fixed schema (never inferred).

    A record that does not fit the schema has its text in ``_corrupt_record``.
    ``archive_dir`` moves every file out of the landing folder once its batch is
    committed (``cleanSource=archive``), so the folder listed on each run stays
    small however long the feed runs.
    """
    reader = spark.readStream.format(fmt).schema(StructType([*schema.fields]).add(RAW_RECORD, StringType()))
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_RECORD)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(source_dir).select("*", F.col("_metadata.file_path").alias(RAW_FILE))


def stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that Spark gave the stream of a checkpoint, once it has started."""
    fs, at = commits.file_system(spark, f"{checkpoint.rstrip('/')}/metadata")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def append_batch(batch: DataFrame, batch_id: int, folder: str, stream: str, schema: StructType, fmt: str) -> State:
    """One micro-batch as one commit of a table folder; nothing if the ledger has it."""
    spark = batch.sparkSession

    def done(state: State | None) -> bool:
        return state is not None and state.streams.get(stream, NOTHING)["batch"] >= batch_id

    before = commits.latest(spark, folder)
    if done(before):
        return before
    version = uuid.uuid4().hex
    path = f"{folder}/versions/{version}"
    with _one_writer_a_part(spark):
        batch.withColumn(BROKEN, F.col(RAW_RECORD).isNotNull()).write.format(fmt).partitionBy(BROKEN).save(path)
    there = {name for name, _ in commits.children(spark, path)}
    parts = [f"{BROKEN}={flag}" if f"{BROKEN}={flag}" in there else None for flag in ("false", "true")]
    rows, quarantined = [spark.read.format(fmt).schema(batch.schema).load(f"{path}/{part}").count() if part else 0 for part in parts]

    def change(state: State | None) -> State | None:
        if done(state):  # the same batch came in by another attempt
            return None
        state = state or _empty(schema, batch.schema, fmt)
        known = state.streams.get(stream, NOTHING)
        entry = {"batch": batch_id, "batches": known["batches"] + (rows + quarantined > 0), "rows": known["rows"] + rows, "quarantined": known["quarantined"] + quarantined}
        return replace(
            state, streams=state.streams | {stream: entry}, info=state.info | {"quarantine": batch.schema.jsonValue()},
            folders=(*state.folders, *([f"{version}/{parts[0]}"] if parts[0] else [])),
            quarantine=(*state.quarantine, *([f"{version}/{parts[1]}"] if parts[1] else [])),
        )

    after = commits.commit(spark, folder, change)
    commits.collect_old(spark, folder, keep=2, retain_seconds=0)
    return after


@contextmanager
def _one_writer_a_part(spark: SparkSession) -> Iterator[None]:
    """A task's rows go straight to its writers: one of whole records, one of broken ones.

    Spark else sorts all rows of a task by the part first, and holds them for that.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "2")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _empty(schema: StructType, raw: StructType, fmt: str) -> State:
    return State(fmt, schema.json(), info={"quarantine": raw.jsonValue()})


def _delta_batch(batch: DataFrame, batch_id: int, target: str, stream: str) -> None:
    """Delta keeps a ledger of its own: a batch that it has is skipped."""
    for part, to in ((batch.where(F.col(RAW_RECORD).isNull()).drop(RAW_RECORD, RAW_FILE), target), (batch.where(F.col(RAW_RECORD).isNotNull()), f"{target}__quarantine")):
        writer = part.write.format("delta").mode("append").option("txnAppId", stream).option("txnVersion", str(batch_id))
        writer.save(to) if "/" in to else writer.saveAsTable(to)


def ingest(spark: SparkSession, fmt: str, source_dir: str, schema: StructType, target: str,
           checkpoint: str, options: dict[str, str] | None = None,
           sink_format: str = "parquet", max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
           timeout_seconds: float | None = None, archive_dir: str | None = None) -> IngestResult:
    """Append all new files of ``source_dir`` to ``target`` and wait for it.

    ``target`` is a catalog table name or, when it contains ``/``, a path.
    """
    stream = read_stream(spark, fmt, source_dir, schema, options, max_files_per_trigger, archive_dir)
    if sink_format == "delta":
        counted = {"batches": 0, "rows": 0, "quarantined": 0}

        def take(batch: DataFrame, batch_id: int) -> None:
            _delta_batch(batch, batch_id, target, stream_id(spark, checkpoint))
            broken = batch.where(F.col(RAW_RECORD).isNotNull()).select(*batch.columns).count()
            for key, n in (("batches", 1), ("rows", batch.count() - broken), ("quarantined", broken)):
                counted[key] += n

        _run(stream, take, checkpoint, target, timeout_seconds)
        return IngestResult(target, **counted)

    folder = table_folder(spark, target)
    commits.commit(spark, folder, lambda state: _empty(schema, stream.schema, sink_format) if state is None else None)
    before = _ledger(spark, target, checkpoint)
    _run(stream, lambda batch, batch_id: append_batch(batch, batch_id, folder, stream_id(spark, checkpoint), schema, sink_format) and None, checkpoint, target, timeout_seconds)
    after = _ledger(spark, target, checkpoint)
    point_catalog(spark, target)
    return IngestResult(target, **{key: after[key] - before[key] for key in ("batches", "rows", "quarantined")})


def _ledger(spark: SparkSession, target: str, checkpoint: str) -> dict:
    """What the stream of a checkpoint has appended so far."""
    return current_state(spark, target).streams.get(stream_id(spark, checkpoint), NOTHING)


def _run(stream: DataFrame, take: Callable[[DataFrame, int], None], checkpoint: str, target: str, timeout_seconds: float | None) -> None:
    """All new files in micro-batches; waits for the end."""
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if not query.awaitTermination(timeout_seconds) and timeout_seconds:  # raises if the query failed
        query.stop()
        raise TimeoutError(f"ingest into {target} did not finish in {timeout_seconds}s")


def ingest_source(spark: SparkSession, source: str, source_dir: str, target: str,
                  checkpoint: str, **kwargs) -> IngestResult:
    """Ingest one of the three known raw sources (``schemas.SOURCES``)."""
    fmt, options, schema = SOURCES[source]
    return ingest(spark, fmt, source_dir, schema, target, checkpoint, options, **kwargs)


def land_raw(df: DataFrame, source: str, landing_dir: str) -> None:
    """Write a bronze-shaped frame as raw files of ``source``'s format (fixtures)."""
    fmt, options, _ = SOURCES[source]
    writer = df.write.mode("append").format(fmt)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save(landing_dir)
