"""The newest rows of each class as a stream keeps them, across micro-batches and restarts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from moodstream.operators.ranking import latest_per_class
from moodstream.sources.stream import file_stream
from moodstream.streaming import jobs, results

SCHEMA = "event_id long, ts timestamp, UserID string, class string, epoch_note string, rank_note int"


def pages(spark, path, count, start=0):
    for page in range(start, start + count):
        rows = spark.range(200).select(
            (F.col("id") + page * 200).alias("event_id"),
            # Ties in time, and every page reaches back behind earlier ones.
            F.timestamp_seconds(1_700_000_000 + page * 60 + (F.col("id") * 37) % 150).alias("ts"),
            F.concat(F.lit("u"), F.col("id") % 9).alias("UserID"),
            F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 50 == 1, "rare").when(F.col("id") % 3 == 0, "negative").otherwise("positive").alias("class"),
            F.lit(None).cast("string").alias("epoch_note"), F.lit(1).alias("rank_note"),
        )
        rows.coalesce(1).write.mode("append").parquet(path)


def newest(df, k):
    return sorted(map(tuple, latest_per_class(df, ("ts", "event_id"), k).drop("rank").collect()), key=str)


def run(spark, path, out, k):
    stream = file_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, "parquet", files_per_batch=1)
    results.run_to_end(jobs.start_latest(stream, out, out + "-checkpoint", ("ts", "event_id"), k))
    return results.latest_epoch(spark, out)


@pytest.mark.parametrize("k", [1, 13])
def test_equal_to_the_batch_after_every_start(spark, tmp_path, k):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for start in (0, 3):
        pages(spark, path, 3, start)
        kept = run(spark, path, out, k)
        assert sorted(map(tuple, kept.collect()), key=str) == newest(spark.read.parquet(path), k)
    epochs = spark.read.parquet(out).groupBy("epoch", "class").count()
    assert epochs.agg(F.max("count")).first()[0] <= k and epochs.select("epoch").distinct().count() == 6


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    import shutil

    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages(spark, path, 3)
    want = sorted(map(tuple, run(spark, path, out, 13).collect()), key=str)
    # As after a failure between the result and its commit: the last micro-batch is not marked as done.
    commits = tmp_path / "out-checkpoint" / "commits"
    for name in ("2", ".2.crc"):
        (commits / name).unlink(missing_ok=True)
    shutil.copytree(tmp_path / "out" / "epoch=1", tmp_path / "copy")
    assert sorted(map(tuple, run(spark, path, out, 13).collect()), key=str) == want


def test_empty_stream(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages(spark, path, 1)
    empty = str(tmp_path / "none")
    spark.read.parquet(path).limit(0).write.parquet(empty)
    assert run(spark, empty, out, 13).collect() == []
