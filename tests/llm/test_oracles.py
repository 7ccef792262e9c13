"""Registered queries against their SQL twins; the twins live with the operators."""

from __future__ import annotations

import pytest

from moodstream.llm.queries import ORACLES, QUERIES
from tools.check import compare, duckdb_on

FOLDER = "/root/testdata/sf0.001"


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(llm, name):
    assert compare(QUERIES[name](llm, FOLDER), duckdb_on(FOLDER), ORACLES[name]) == ""
