"""Result tables that micro-batches write and readers see as a whole."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def epoch_writer(path: str, shape: Callable[[DataFrame, int], DataFrame] | None = None):
    """``foreachBatch`` function that stores each micro-batch under its own number.

    A batch that runs again after a failure overwrites its own folder, so nothing is doubled.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = shape(batch, batch_id) if shape else batch
        out.write.mode("overwrite").parquet(f"{path}/epoch={batch_id}")

    return write


def latest_epoch(spark: SparkSession, path: str) -> DataFrame:
    """The result of the last micro-batch, for streams that emit the complete result."""
    rows = spark.read.parquet(path)
    last = rows.agg(F.max("epoch").alias("epoch")).scalar()
    return rows.filter(F.col("epoch") == last).drop("epoch")


def latest_values(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key, for streams that emit changed keys only."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    return rows.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.col("epoch")).alias("row")
    ).select(*keys, "row.*")


def window_tables(spark: SparkSession, out: str, ts: str = "ts", window: str = "1 hour") -> DataFrame:
    """``(window_start, class, kind, n)`` of a stream with final windows: ``final``, still ``open``, and ``late`` rows."""
    final = spark.read.parquet(f"{out}/final").select("window_start", "class", F.lit("final").alias("kind"), "n")
    still = latest_epoch(spark, f"{out}/open").select("window_start", "class", F.lit("open").alias("kind"), "n")
    late = spark.read.parquet(f"{out}/late").groupBy(F.window(ts, window).alias("w"), "class").agg(F.count(F.lit(1)).alias("n"))
    return final.unionByName(still).unionByName(late.select(F.col("w.start").alias("window_start"), "class", F.lit("late").alias("kind"), "n"))


def run_to_end(query) -> None:
    """Wait for a stream that stops by itself, and pass on its error."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
