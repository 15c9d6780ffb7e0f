"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import subprocess
import sys

import pytest

from tests.conftest import ROOT
from playerlake.session import SEMANTIC_CONF, checkpoint_root, configure, scratch_dir


def test_semantic_settings_applied(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    for key, value in SEMANTIC_CONF.items():
        assert spark.conf.get(key) == value


def test_scratch_folders_live_under_the_configured_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/playerlake/x-")


def test_settings_of_the_cluster_are_left_alone():
    code = """
from pyspark.sql import SparkSession
from playerlake.session import build_session
first = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.autoBroadcastJoinThreshold", "-1").getOrCreate()
spark = build_session()
print("GOT", spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold"))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=ROOT)
    assert "GOT -1 33554432" in out.stdout, out.stderr[-2000:]


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
