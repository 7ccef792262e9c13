"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as spark_entry
from tools.check import compare, duckdb_on

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duckdb_on(FOLDER)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == ""


@needs_tables
def test_approximate_users_are_close(spark):
    rows = QUERIES["user_totals_approx"](spark, FOLDER).collect()
    exact = QUERIES["user_totals"](spark, FOLDER).first()
    for r in rows:
        assert r["comments"] == exact[f"comments_{r['class']}"]
        assert abs(r["users"] - exact[f"users_{r['class']}"]) <= 0.2 * exact[f"users_{r['class']}"] + 1


@needs_tables
def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["Emotion", "n"] and df.count() == 3
