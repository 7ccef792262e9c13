from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodstream.functions import messages
from moodstream.operators.basics import with_class
from moodstream.operators.flatten import flatten_json, flatten_record
from moodstream.operators.rollups import class_counters
from moodstream.sinks.stream import to_payload


def _df(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string")


def test_pairs_and_objects(spark):
    rows = _df(spark, [
        json.dumps({"comments": [["u1", "xin, \"chào\"\n"], ["u2", "đẹp"]]}),
        json.dumps({"comments": [{"UserID": "u3", "Sentence": "ok"}]}),
        json.dumps({"comments": []}),
    ])
    got = messages.comments_from_messages(rows, ["id"]).orderBy("id", "pos").collect()
    assert [tuple(r) for r in got] == [
        (0, 0, "u1", "xin, \"chào\"\n"), (0, 1, "u2", "đẹp"), (1, 0, "u3", "ok"),
    ]


def test_bad_messages_are_set_aside(spark):
    rows = _df(spark, ['{"comments": [["u", "a"]]}', "not json", '{"other": 1}', None])
    good, bad = messages.split_messages(rows)
    assert [r["id"] for r in good.collect()] == [0]
    assert sorted(r["id"] for r in bad.collect()) == [1, 2, 3]
    assert messages.comments_from_messages(rows, ["id"]).count() == 1


def test_double_encoded_items(spark):
    items = [
        '{"UserID":"u","Sentence":"a","prediction":2.0,"Sentence":"a","prediction":2.0}',
        {"UserID": "u", "Sentence": "b", "prediction": 0.0},
        '{"UserID":"u","Sentence":"c"}',
        '{"UserID":"u","Sentence":"d","prediction":null}',
        '{"UserID":"u","Sentence":"e","prediction":3.0}',
        '{"UserID":"u","Sentence":"f","prediction":-1.0}',
        '{"UserID":"u","Sentence":"g","prediction":1}',
        '{"UserID":"u","Sentence":"x","prediction":1.0,"Sentence":"y","prediction":0.0}',
    ]
    rows = _df(spark, [json.dumps({"comments": items})])
    scored = with_class(messages.scored_from_messages(rows))
    got = [tuple(r) for r in scored.orderBy("pos").select("Sentence", "prediction", "class").collect()]
    assert got == [
        ("a", 2.0, "negative"), ("b", 0.0, "neutral"), ("c", None, None), ("d", None, None),
        ("e", 3.0, None), ("f", -1.0, None), ("g", 1.0, "positive"), ("y", 0.0, "neutral"),
    ]
    counts = scored.agg(*class_counters()).first()
    assert counts.asDict() == {"positive": 1, "negative": 1, "neutral": 2}


def test_payload_can_be_read_back(spark):
    rows = spark.createDataFrame(
        [("u1", 'say "hi"\n', 1.0), ("u2", "đẹp", None)], "UserID string, Sentence string, prediction double"
    )
    payload = to_payload(rows)
    assert sorted(r["key"] for r in payload.collect()) == ["u1", "u2"]
    back = messages.scored_from_messages(payload).select("UserID", "Sentence", "prediction")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    plain = [json.loads(r["value"]) for r in to_payload(rows, envelope=False).collect()]
    assert {"UserID": "u2", "Sentence": "đẹp"} in plain  # null left out


def test_unnest_keeps_null_items(spark):
    rows = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "id int, xs array<string>")
    assert sorted(map(tuple, messages.unnest(rows, "xs").collect()), key=str) == [(1, 0, "a"), (1, 1, None)]
    assert messages.unnest(rows, "xs", pos=None).columns == ["id", "item"]


RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("author", T.StructType([T.StructField("id", T.StringType()), T.StructField("tag.x", T.LongType())])),
    T.StructField("stats", T.StructType([T.StructField("playCount", T.LongType())])),
    T.StructField("challenges", T.ArrayType(T.StructType([T.StructField("id", T.StringType())]))),
    T.StructField("textExtra", T.ArrayType(T.StringType())),
    T.StructField("createTime", T.LongType()),
])


def test_flatten(spark):
    record = {
        "id": "v1", "author": {"id": "a1", "tag.x": 4}, "stats": {"playCount": 7},
        "challenges": [{"id": "c"}], "textExtra": ["t"], "createTime": 5,
    }
    rows = _df(spark, [json.dumps(record), json.dumps({"id": "v2"})])
    flat = flatten_json(rows, "value", RECORD)
    assert flat.columns == ["id", "author_id", "author_tag.x", "stats_playCount", "createTime"]
    assert sorted(map(tuple, flat.collect())) == [("v1", "a1", 4, 7, 5), ("v2", None, None, None, None)]
    nested = rows.select(F.from_json("value", RECORD).alias("r")).select("r.*")
    assert flatten_record(nested).columns == flat.columns
