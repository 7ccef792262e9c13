"""Whole workflows: train from files, score files or a topic, summarise scored comments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream import schemas
from moodstream.operators import basics, ranking, rollups
from moodstream.plans import metrics, model
from moodstream.session import materialise
from moodstream.sinks import files as file_sinks
from moodstream.sources import files


@dataclass(frozen=True)
class Training:
    """What a training run gives: the model, its hold-out quality, and tables to look at."""

    model: PipelineModel
    f1: float
    accuracy: float
    distribution: DataFrame
    test_predictions: DataFrame
    misfits: DataFrame


def train_from_csv(
    spark: SparkSession,
    paths: Sequence[str],
    save_to: str | None = None,
    features: model.Features = model.TFIDF,
    classifier: Estimator | None = None,
    test_share: float = 0.2,
    seed: int = 100,
    fit_features_on_all: bool = False,
) -> Training:
    """Read labelled CSV files, unite them, split, train, evaluate on the hold-out, and save.

    Rows that do not fit the schema or lack a text or label cannot teach; they are returned as
    ``misfits``, with their source line where it did not fit. The rows are written to the shared folder
    once, so the split is the same however often they are read.
    """
    read = basics.bag_union(*[files.csv_table(spark, p, schemas.LABELLED) for p in paths])
    whole = F.col(schemas.CORRUPT).isNull() & F.col("Sentence").isNotNull() & F.col("Emotion").isNotNull()
    stored = materialise(read.withColumn("_whole", whole), "labelled")
    rows = stored.filter("_whole").drop(schemas.CORRUPT, "_whole")
    rows = rows.toDF(features.text, features.label)
    train, test = model.random_split(rows, (1 - test_share, test_share), seed)
    fitted = model.train(train, features, classifier, rows if fit_features_on_all else None)
    if save_to:
        model.save(fitted, save_to)
    predictions = model.score(test, fitted, features)
    pairs = predictions.select(F.col(features.label).alias("actual"), F.col("class").alias("predicted"))
    table = materialise(metrics.confusion(pairs), "confusion")
    return Training(
        fitted,
        metrics.weighted_f1(table).first()[0],
        metrics.accuracy(table).first()[0],
        rollups.class_distribution(rows, features.label),
        predictions,
        stored.filter("not _whole").drop("_whole"),
    )


def score_csv(
    spark: SparkSession, path: str, fitted: PipelineModel, features: model.Features = model.TFIDF
) -> DataFrame:
    """Texts of a one-column CSV, every row of it, with ``probability, prediction, class``."""
    rows = files.scoring_csv(spark, path).toDF(features.text)
    return model.score(rows, fitted, features)


def merge_csv(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """Merge the CSV files of a folder by column name into one table and return it."""
    merged = files.merged_csv(spark, folder)
    file_sinks.write_csv(merged, out, bom=True)
    return merged


def dashboard(
    scored: DataFrame,
    batch: str,
    block: Column,
    order: Sequence[str],
    user: str = "UserID",
    points: int = 10,
    latest: int = 13,
) -> dict[str, DataFrame]:
    """The tables behind a dashboard, for scored rows with a ``class`` and a ``batch`` column.

    ``snapshots`` are cumulative counters of the newest batches, ``share`` the percent per class,
    ``totals`` comments and users, ``latest`` the newest comments of each class in ``order``.
    The counters per batch are written once, and snapshots and shares come from that small table.
    """
    counts = materialise(rollups.class_counts_by_batch(scored, batch), "batch-counts")
    running = rollups.running_totals(counts, batch, block)
    return {
        "snapshots": ranking.last_rows(running, batch, points),
        "share": rollups.share_of_batches(counts),
        "totals": rollups.user_totals(scored, user),
        "latest": ranking.latest_per_class(scored, order, latest),
    }


def archive_dashboard(
    spark: SparkSession, folder: str, pattern: str = "*.json", block: Column | None = None, **settings
) -> dict[str, DataFrame]:
    """Dashboard tables over archived batches: one file is one batch, in file name order.

    Running totals are made in parallel per ``block``, an expression over ``file`` that grows with it;
    by default the file's folder, so archives are best kept in dated folders.
    """
    scored = files.scored_archive(spark, folder, pattern)
    block = F.regexp_replace("file", "[^/]*$", "") if block is None else block
    return dashboard(scored, "file", block, ["file", "pos"], **settings)
