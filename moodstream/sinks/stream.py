"""Payload rows for a message topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.functions.messages import message_json, published_columns, row_json


def to_payload(
    scored: DataFrame,
    columns: Sequence[str] = ("UserID", "Sentence", "prediction"),
    envelope: bool = True,
) -> DataFrame:
    """``(key, value)`` rows, one per comment.

    With ``envelope`` the value is ``{"comments": ["<json>"]}``, which is what readers of the scored
    topic expect; without, it is the comment object itself. ``prediction`` is the fixed code of the
    row's ``class``, which goes along, not the index of the model that made it.
    """
    body = row_json(*published_columns(columns, scored.columns))
    value = message_json(F.array(body)) if envelope else body
    return scored.select(F.col(columns[0]).cast("string").alias("key"), value.alias("value"))


def kafka_sink_options(topic: str, servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish(df: DataFrame, topic: str, servers: str) -> None:
    """Send payload rows to a topic as a batch. Needs the Kafka connector package."""
    df.write.format("kafka").options(**kafka_sink_options(topic, servers)).save()
