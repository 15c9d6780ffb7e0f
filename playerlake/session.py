"""Spark session settings the pipeline depends on.

* *semantic* settings change results and are applied to every session that runs
  our plans (``configure``): dates, weekdays and months are taken in UTC, ANSI
  mode is on (bad input is handled explicitly with ``try_*`` functions), and
  identifiers are case-insensitive as the source notebooks assume;
* *skew* settings (also applied by ``configure``) let AQE split a partition that
  holds a hot key, even under a parent aggregate; they act only on measured skew;
* *scale* settings apply only where the cluster set none; they change the physical
  plan alone: AQE re-plans every stage from
  real shuffle statistics, coalesces small partitions and turns a sort-merge
  join into a broadcast join only when the measured build side is under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
* *planning* settings cut driver-side overhead while plans are built.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.caseSensitive": "false",
}

# Skew handling, applied to every session that runs our plans (configure). AQE
# splits a partition that holds a hot key between the two sides of a
# sort-merge join. By default it gives up when the split would need one more
# shuffle for a parent operator (a per-player aggregate right after the join):
# that shuffle only carries partial aggregates, so forcing the split is always
# worth it. These settings change a plan only when skew is measured at run time.
SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

SCALE_CONF = {
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Two size checks, no hints: a side whose files (the static estimate) are under
    # 10 MB, or that AQE has measured under 32 MB at run time.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
}

# Driver-side only: do not record the Python call site of every DataFrame API
# call in the JVM (several extra Py4J round trips per call while planning).
# Error messages lose the Python line, results are unchanged.
PLANNING_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "playerlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the semantic and scale settings applied.

    ``shuffle_partitions`` is the *initial* partition count; AQE coalesces it
    down at run time, so on a cluster it should be sized for the largest shuffle
    (roughly shuffle bytes / 128 MB), not for the smallest. Scale
    settings that ``spark-submit`` or the cluster has set are left alone.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    given = {**PLANNING_CONF, **(extra or {})}  # a static setting: only a builder can give it
    if shuffle_partitions is not None:
        given["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in given.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SCALE_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic and skew settings to an existing session (idempotent)."""
    for key, value in {**SEMANTIC_CONF, **SKEW_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at storage every
    executor can reach; we only read it. When it is unset in local mode (a unit
    test on a laptop) a private folder is created and registered, so later calls
    agree. Elsewhere a machine-local folder would lose data: that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="playerlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/playerlake/{purpose}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = [
    "SEMANTIC_CONF",
    "SKEW_CONF",
    "SCALE_CONF",
    "PLANNING_CONF",
    "build_session",
    "configure",
    "checkpoint_root",
    "scratch_dir",
    "local_path",
]
