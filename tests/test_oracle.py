"""Every checked query equals its SQL statement in DuckDB."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = compare.rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    want = compare.rows_of([d[0] for d in cur.description], cur.fetchall())
    assert compare.difference(got, want) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["hospital_id", "hospital_name"]
