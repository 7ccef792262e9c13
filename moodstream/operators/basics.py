"""Projection, constants, ids, null handling, routing and unions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.functions.classes import CLASSES, class_name


def project(df: DataFrame, *columns: str) -> DataFrame:
    """Select columns, each at most once."""
    return df.select(*dict.fromkeys(columns))


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def with_row_id(df: DataFrame, name: str = "uid") -> DataFrame:
    """Unique id per row. Not stable between runs: prefer ids the source carries."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_stable_id(df: DataFrame, *source_columns: str, name: str = "uid") -> DataFrame:
    """Id built from the columns that identify a row at its source, equal in every run."""
    return df.withColumn(name, F.concat_ws("/", *[F.col(c).cast("string") for c in source_columns]))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without any null in ``columns`` (all by default)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def other_than(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column differs from ``value``; null does not differ."""
    return df.filter(F.col(column) != F.lit(value))


def with_class(df: DataFrame, prediction: str = "prediction", name: str = "class") -> DataFrame:
    """Add the class name of a prediction code; unknown codes give null."""
    return df.withColumn(name, class_name(F.col(prediction)))


def route(df: DataFrame, name: str = "class") -> dict[str, DataFrame]:
    """One lazily filtered DataFrame per class."""
    return {c: df.filter(F.col(name) == c) for c in CLASSES}


def bag_union(*frames: DataFrame) -> DataFrame:
    """Union by position, duplicates kept."""
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per named frame with its row count, as a single job."""
    return bag_union(
        *[
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, df in frames.items()
        ]
    )


def join_predictions(inputs: DataFrame, predictions: DataFrame, key: str = "uid") -> DataFrame:
    """Add stored predictions to their inputs, one to one, and drop the key.

    Columns both sides have are taken from ``inputs`` only. No broadcast is forced: Spark picks it
    when the predictions are below its size limit and a shuffled join otherwise.
    """
    extra = [c for c in predictions.columns if c == key or c not in inputs.columns]
    return inputs.join(predictions.select(*extra), key, "inner").drop(key)
