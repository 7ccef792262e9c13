from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from moodstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="moodstream-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate column expressions on one-column string rows, in order."""

    def run(expression, inputs, kind="string"):
        rows = [(i, v) for i, v in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r["out"] for r in df.select("i", expression.alias("out")).orderBy("i").collect()]

    return run
