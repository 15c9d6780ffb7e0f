"""Shared Spark session for the test suite (local mode, UTC, small shuffles)."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from playerlake.session import build_session, checkpoint_root

    session = build_session("local[4]", app_name="playerlake-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_root(session)  # set a private one only if the cluster named none
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from playerlake.session import scratch_dir

    return scratch_dir(spark, "test")
