"""Top-k and last-n, globally and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(
    df: DataFrame, group: str, order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark keeps at most ``k`` rows per group and task before the shuffle, so one group holding most
    rows costs no more than any other.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def latest_per_class(
    df: DataFrame, order: Sequence[str], k: int = 13, column: str = "class"
) -> DataFrame:
    """Newest ``k`` comments of each class; ``order`` must identify a row."""
    known = df.filter(F.col(column).isNotNull())
    return first_per_group(known, column, [F.desc(c) for c in order], k)


def cap_children(df: DataFrame, parent: str, order: str, k: int = 5) -> DataFrame:
    """At most ``k`` children per parent, in order."""
    return first_per_group(df, parent, [F.asc(order)], k, "_rank").drop("_rank")


def last_rows(df: DataFrame, order: str, k: int = 10) -> DataFrame:
    """The ``k`` newest rows."""
    return df.orderBy(F.desc(order)).limit(k)


def confidence(probability: str = "probability") -> Column:
    """Largest class probability."""
    return F.array_max(vector_to_array(F.col(probability)))


def top_by_confidence(
    df: DataFrame, k: int = 10, probability: str = "probability", id_col: str = "doc_id", digits: int = 6
) -> DataFrame:
    """The ``k`` rows the model is most certain of; confidences equal to ``digits`` places go by id."""
    rows = df.withColumn("confidence", F.round(confidence(probability), digits))
    return rows.orderBy(F.desc("confidence"), F.asc(id_col)).limit(k)


def top_by_first_class(
    df: DataFrame, k: int = 10, probability: str = "probability", prediction: str = "prediction",
    id_col: str = "doc_id", digits: int = 6,
) -> DataFrame:
    """The ``k`` rows not predicted as class 0, by rounded probability vector, first element first, then id."""
    rounded = F.transform(vector_to_array(probability), lambda p: F.round(p, digits))
    rows = df.filter(F.col(prediction) != 0).withColumn("_rounded", rounded)
    return rows.orderBy(F.desc("_rounded"), F.asc(id_col)).limit(k).drop("_rounded")
