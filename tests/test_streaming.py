from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from moodstream import schemas
from moodstream.functions.messages import scored_from_messages
from moodstream.operators.basics import with_class
from moodstream.plans import model
from moodstream.sinks.stream import to_payload
from moodstream.sources import stream
from moodstream.streaming import jobs, results

EVENTS = "event_id long, ts timestamp, UserID string, prediction double"


def _event(i, minute, prediction):
    return {"event_id": i, "ts": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z", "UserID": "u", "prediction": prediction}


def _put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def _events(spark, folder, **more):
    return with_class(stream.file_stream(spark, str(folder), EVENTS, **more))


def test_counts_continue_after_restart(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    _put(source, "1.json", [_event(1, 0, 0.0), _event(2, 1, 2.0), _event(3, 2, None)])
    for _ in range(2):  # the second run finds nothing new
        results.run_to_end(jobs.start_class_counts(_events(spark, source), out, checkpoint))
    assert dict(map(tuple, results.latest_epoch(spark, out).collect())) == {"neutral": 1, "negative": 1}
    _put(source, "2.json", [_event(4, 3, 2.0), _event(5, 4, 1.0), _event(6, 5, 7.0)])
    results.run_to_end(jobs.start_class_counts(_events(spark, source), out, checkpoint))
    assert dict(map(tuple, results.latest_epoch(spark, out).collect())) == {"neutral": 1, "negative": 2, "positive": 1}


def test_windows_equal_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    rows = [_event(i, (i * 37) % 300, float(i % 3)) for i in range(120)]
    for n in range(4):
        _put(source, f"{n}.json", rows[n * 30 : n * 30 + 30])
    events = _events(spark, source, files_per_batch=1)
    results.run_to_end(jobs.start_window_counts(events, out, str(tmp_path / "cp"), watermark="1 day"))
    got = results.latest_values(spark, out, ["window_start", "class"])
    batch = with_class(spark.read.schema(EVENTS).json(str(source)))
    want = batch.groupBy(F.date_trunc("hour", "ts").alias("window_start"), "class").agg(F.count(F.lit(1)).alias("n"))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_snapshot_per_micro_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for n in range(12):
        _put(source, f"{n:02d}.json", [_event(n, n, 1.0), _event(100 + n, n, 0.0)])
    events = _events(spark, source, files_per_batch=1)
    results.run_to_end(jobs.start_snapshots(events, out, str(tmp_path / "cp")))
    got = jobs.snapshots(spark, out, 10).collect()
    assert [r["batch_id"] for r in got] == list(range(11, 1, -1))
    assert [(r["positive"], r["neutral"], r["negative"]) for r in got] == [(n, n, 0) for n in range(12, 2, -1)]
    assert all(r["taken_at"] is not None for r in got)


def test_batch_that_runs_twice_is_stored_once(spark, tmp_path):
    write = results.epoch_writer(str(tmp_path / "out"))
    for _ in range(2):
        write(spark.createDataFrame([("a", 1)], "class string, n long"), 3)
    assert results.latest_epoch(spark, str(tmp_path / "out")).count() == 1


@pytest.fixture(scope="module")
def bayes(spark):
    rows = [("good great fine", "positive"), ("bad sad awful", "negative"), ("lamp chair", "neutral")] * 10
    df = spark.createDataFrame(rows + [("good", "positive")], "Sentence string, Emotion string")
    return model.train(df, model.BAG_OF_WORDS, model.naive_bayes())


def test_message_stream_scored_like_batch_and_published(spark, tmp_path, bayes):
    source = tmp_path / "topic"
    pairs = [["u1", "@an good great"], ["u2", "bad, sad"], ["u3", "lamp"], ["u4", None]]
    _put(source, "1.json", [{"key": None, "value": json.dumps({"comments": pairs})}, {"key": None, "value": "broken"}])
    comments = jobs.comments_from_payload(stream.file_stream(spark, str(source)))
    out = str(tmp_path / "scored")
    results.run_to_end(jobs.start_scoring(comments, bayes, out, str(tmp_path / "cp1"), model.BAG_OF_WORDS))
    got = spark.read.parquet(out)
    assert {(r["UserID"], r["Sentence"], r["class"]) for r in got.collect()} == {
        ("u1", " good great", "positive"), ("u2", "bad, sad", "negative"), ("u3", "lamp", "neutral"), ("u4", None, "positive")
    }
    batch = jobs.comments_from_payload(spark.read.schema(schemas.PAYLOAD).json(str(source)))
    same = model.score(batch, bayes, model.BAG_OF_WORDS).select("UserID", "Sentence", "prediction", "class")
    assert sorted(map(tuple, got.select(same.columns).collect()), key=str) == sorted(map(tuple, same.collect()), key=str)

    # Publish to a folder in the shape of a topic and read it as a consumer would.
    scored = model.score(comments, bayes, model.BAG_OF_WORDS)
    topic = str(tmp_path / "dashboard")
    query = jobs.start_publishing(to_payload(scored), str(tmp_path / "cp2"), "json", path=topic)
    results.run_to_end(query)
    back = scored_from_messages(spark.read.schema(schemas.PAYLOAD).json(topic))
    assert {(r["UserID"], r["class"], r["prediction"]) for r in back.collect()} == {
        ("u1", "positive", 1.0), ("u2", "negative", 2.0), ("u3", "neutral", 0.0), ("u4", "positive", 1.0)
    }


STREAMS = ("stream_class_counts", "stream_archive", "stream_negative_users", "stream_window_counts", "stream_snapshots", "stream_score")


def test_streams_over_tables_of_several_files(spark, tmp_path):
    from moodstream.plans.catalogue import QUERIES

    small = "/root/testdata/sf0.001"
    for name in ("events", "documents", "labels"):
        spark.read.parquet(f"{small}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in STREAMS:
        one, three = (Counter(map(str, QUERIES[name](spark, folder).collect())) for folder in (small, str(tmp_path)))
        assert one == three and one, name
    with pytest.raises(Exception):
        QUERIES["stream_class_counts"](spark, str(tmp_path / "nothing"))


def test_stream_error_is_passed_on(spark, tmp_path):
    source = tmp_path / "in"
    _put(source, "1.json", [_event(1, 0, 0.0)])
    broken = _events(spark, source).withColumn("class", F.raise_error(F.lit("no class")).cast("string"))
    with pytest.raises(Exception, match="no class"):
        results.run_to_end(jobs.start_class_counts(broken, str(tmp_path / "o"), str(tmp_path / "c")))


def test_interval_trigger_keeps_running(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    _put(source, "1.json", [_event(1, 0, 0.0)])
    query = jobs.start_class_counts(_events(spark, source), out, str(tmp_path / "cp"), every="1 second")
    try:
        query.processAllAvailable()
        _put(source, "2.json", [_event(2, 1, 0.0)])
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert [tuple(r) for r in results.latest_epoch(spark, out).collect()] == [("neutral", 2)]


def test_session_setting_is_put_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    _put(tmp_path / "in", "1.json", [_event(1, 0, 0.0)])
    results.run_to_end(jobs.start_class_counts(_events(spark, tmp_path / "in"), str(tmp_path / "o"), str(tmp_path / "c")))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_archive_and_negative_users_grow_by_batch(spark, tmp_path):
    source, arch, neg = tmp_path / "in", str(tmp_path / "arch"), str(tmp_path / "neg")
    columns = ("event_id", "UserID", "prediction")
    for n in range(3):
        _put(source, f"{n}.json", [_event(n, n, 2.0), _event(10 + n, n, None)])
        events = _events(spark, source)
        results.run_to_end(jobs.start_archive(events, arch, str(tmp_path / "cp1"), columns))
        results.run_to_end(jobs.start_negative_users(events, neg, str(tmp_path / "cp2"), comment="event_id"))
    lines = [json.loads(r["value"]) for r in spark.read.text(arch).collect()]
    assert sorted(r["event_id"] for r in lines) == [0, 1, 2, 10, 11, 12]
    assert all(("prediction" in r) == (r["event_id"] < 10) for r in lines)
    assert sorted(r["event_id"] for r in spark.read.parquet(neg).collect()) == [0, 1, 2]


def test_unreadable_messages_are_kept(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "bad")
    good = json.dumps({"comments": [["u", "a"]]})
    _put(source, "1.json", [{"key": "a", "value": good}, {"key": "b", "value": "broken"}, {"key": "c", "value": None}])
    payload = stream.file_stream(spark, str(source))
    results.run_to_end(jobs.start_quarantine(payload, out, str(tmp_path / "cp")))
    assert sorted((r["key"], r["value"]) for r in spark.read.parquet(out).collect()) == [("b", "broken"), ("c", None)]
