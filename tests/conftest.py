"""Shared fixtures: one local Spark session for the whole test run."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

LOCAL_CONF = {
    "spark.master": "local[4]",
    "spark.driver.memory": "4g",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from orderscope.session import get_session
    session = get_session("orderscope-tests", LOCAL_CONF)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_small():
    from orderscope.plans.compare import duckdb_connection
    return duckdb_connection(SF_SMALL)


def rows(df, order=None):
    """Collected rows as dicts, optionally sorted by a key."""
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=order) if order else out
