from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardmill.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="wardmill-shared-")
    # Tests that count executions need all of them kept; the default of 1,000 is reached before the last test.
    session = build_session("tests", "local[4]", 4, "6g", {"spark.checkpoint.dir": shared, "spark.sql.ui.retainedExecutions": "20000"})
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="wardmill-test-")


def rows(df, *order):
    """Plain tuples, sorted by the given columns (or all of them)."""
    got = [tuple(r) for r in df.collect()]
    at = [df.columns.index(n) for n in order] if order else range(len(df.columns))
    return sorted(got, key=lambda r: tuple((r[i] is None, str(r[i])) for i in at))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
