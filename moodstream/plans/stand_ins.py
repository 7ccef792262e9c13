"""The tables of a data folder in the roles of comments, labels and scored comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.functions.classes import class_code, class_name
from moodstream.sources.files import table

# Class of each event type.
EVENT_CLASS = {
    "error": "negative",
    "view": "neutral",
    "click": "neutral",
    "purchase": "positive",
    "signup": "positive",
}


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, UserID, Sentence)``: documents as comments of their source."""
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.col("source").alias("UserID"), F.col("text").alias("Sentence"))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, Emotion)``."""
    emotion = (
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    )
    return table(spark, folder, "labels").select("doc_id", emotion.alias("Emotion"))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, UserID, Sentence, Emotion)`` for documents that have a label."""
    return comments(spark, folder).join(labels(spark, folder), "doc_id")


def event_prediction(event_type: Column) -> Column:
    """Prediction code of an event type; null for an unknown type."""
    name = None
    for known, label in EVENT_CLASS.items():
        match = event_type == known
        name = F.when(match, label) if name is None else name.when(match, label)
    return class_code(name)


def as_scored(events: DataFrame) -> DataFrame:
    """Event rows as scored comments. Works on streams."""
    return events.select(
        "event_id",
        "ts",
        F.col("user_id").cast("string").alias("UserID"),
        F.col("event_type").alias("Sentence"),
        event_prediction(F.col("event_type")).alias("prediction"),
    ).withColumn("class", class_name(F.col("prediction")))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """``(event_id, ts, UserID, Sentence, prediction, class)``."""
    return as_scored(table(spark, folder, "events"))
