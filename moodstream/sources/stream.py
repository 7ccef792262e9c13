"""Message streams: Kafka topics, and folders of files in the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from moodstream import schemas

# Topic names.
RAW_TOPIC = "quickstart"
SCORED_TOPIC = "Dashboard"


def kafka_options(topic: str, servers: str, start: str = "latest", **more: str) -> dict[str, str]:
    """Options of the Kafka source. Offsets are kept in the query's checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": "true",
    }
    options.update({k.replace("__", "."): v for k, v in more.items()})
    return options


def kafka_stream(
    spark: SparkSession, topic: str = RAW_TOPIC, servers: str = "localhost:9092", **more: str
) -> DataFrame:
    """Topic as a stream of ``key, value`` bytes and offsets. Needs the Kafka connector package."""
    return spark.readStream.format("kafka").options(**kafka_options(topic, servers, **more)).load()


def kafka_table(
    spark: SparkSession, topic: str = RAW_TOPIC, servers: str = "localhost:9092", **more: str
) -> DataFrame:
    """What the topic holds now, as a batch."""
    options = kafka_options(topic, servers, **{"start": "earliest", **more})
    return spark.read.format("kafka").options(**options).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.PAYLOAD,
    file_format: str = "json",
    pattern: str | None = None,
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Files of a folder as a stream. New files are found by listing, each is read once.

    ``files_per_batch`` is the page size of an incremental read; the cursor is the checkpoint.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
