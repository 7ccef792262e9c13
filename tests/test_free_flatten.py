from __future__ import annotations

import json

import pytest

from moodstream.operators import free_flatten
from moodstream.operators.flatten import DROPPED

RECORDS = [
    {"id": 1, "a": {"x": 1, "y": "t", "deep": {"k": [1, {"z": None}]}}, "b": [1, 2], "m": 1, "a_x": "top", "contents": {"z": 1}},
    {"id": 2.5, "a": {"x": "clash"}, "m": {"k": 1}, "t": True, "we`ird 'k.": 1, "": "no name"},
    {"id": None, "a": None, "empty": {}, "never": None},
    {"id": 10**17, "challenges": [1], "t": False, "é": "ü\"\\\n"},
    {},
]
ODD = ["not json", "[1]", "3", None, "", '{"id":1,"id":2}', "null"]


@pytest.fixture
def flat(spark):
    rows = [(i, r) for i, r in enumerate([*(json.dumps(r, ensure_ascii=False) for r in RECORDS), *ODD])]
    return free_flatten.flatten_any(spark.createDataFrame(rows, "n int, v string"), "v", keep=("n",))


def test_columns_are_the_union_of_keys(flat):
    assert flat.columns == ["n", *sorted(["", "a__x", "a_y", "a_deep", "a_x", "b", "id", "m", "never", "t", "we`ird 'k.", "é"])]
    kinds = dict(flat.dtypes)
    assert (kinds["id"], kinds["t"], kinds["a_x"], kinds["a_y"], kinds["m"], kinds["we`ird 'k."]) == ("double", "boolean", "string", "string", "string", "bigint")


def test_values(flat):
    rows = {r["n"]: r.asDict() for r in flat.collect()}
    assert len(rows) == len(RECORDS) + len(ODD)
    assert [rows[i]["id"] for i in range(5)] == [1.0, 2.5, None, 1e17, None]
    assert [rows[i]["a__x"] for i in range(3)] == ["1", '"clash"', None] and rows[0]["a_x"] == "top"
    assert json.loads(rows[0]["a_deep"]) == {"k": [1, {"z": None}]} and rows[0]["b"] == "[1,2]"
    assert (rows[0]["m"], rows[1]["m"]) == ("1", '{"k":1}') and rows[3]["é"] == 'ü"\\\n'
    assert (rows[1]["t"], rows[3]["t"], rows[1]["we`ird 'k."], rows[1][""]) == (True, False, 1, "no name")
    assert all(v is None for n in range(4, len(rows)) for k, v in rows[n].items() if k != "n")


def test_key_pass(spark):
    df = spark.createDataFrame([(json.dumps(r),) for r in RECORDS], "v string")
    keys = {(r["parent"], r["child"]): r["kinds"] for r in free_flatten.record_keys(df, "v").collect()}
    assert not {p for p, _ in keys} & set(DROPPED)
    assert keys["m", None] == ["BIGINT", "OBJECT"] and keys["a", None] == ["OBJECT"] and keys["never", None] == []


def test_equal_records_and_repeated_rows_stay(spark):
    df = spark.createDataFrame([('{"k": 1}',)] * 3, "v string")
    assert [r["k"] for r in free_flatten.flatten_any(df, "v").collect()] == [1, 1, 1]


def test_keys_that_are_data_are_refused(spark, monkeypatch):
    monkeypatch.setattr(free_flatten, "MAX_COLUMNS", 3)
    df = spark.createDataFrame([(json.dumps({f"k{i}": 1}),) for i in range(5)], "v string")
    with pytest.raises(ValueError, match="more than 3 keys"):
        free_flatten.flatten_any(df, "v")


def test_empty_table(spark):
    df = spark.createDataFrame([], "n int, v string")
    out = free_flatten.flatten_any(df, "v", keep=("n",))
    assert out.columns == ["n"] and out.collect() == []
