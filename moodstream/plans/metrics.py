"""Quality of predictions, from the confusion table."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate(predictions: DataFrame, metric: str = "f1", label: str = "label") -> float:
    """Spark's metric on predicted rows. The default is the weighted f1."""
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName=metric
    ).evaluate(predictions)


def confusion(predictions: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """``(actual, predicted, n)``. All metrics below need only this small table."""
    return predictions.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))


def accuracy(table: DataFrame) -> DataFrame:
    """One row: share of rows on the diagonal."""
    hit = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    return table.agg((hit / F.sum("n")).alias("accuracy"))


def weighted_f1(table: DataFrame) -> DataFrame:
    """One row: f1 per class, weighted by the number of actual rows of the class."""
    return weighted_f1_by(table)


def weighted_f1_by(table: DataFrame, *by: str) -> DataFrame:
    """The weighted f1 of every group of confusion cells.

    Every cell of the table counts once for its actual and once for its predicted class.
    """
    sides = table.select(
        *by,
        F.explode(
            F.array(
                F.struct(
                    F.col("actual").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("claimed"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("predicted").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("claimed"),
                    F.lit(0).cast("long").alias("hit"),
                ),
            )
        ).alias("side")
    ).select(*by, "side.*")
    per_class = sides.groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hit").alias("hit")
    )
    # 2PR / (P + R) = 2 hit / (support + claimed); defined whenever the class occurs at all.
    f1 = F.lit(2.0) * F.col("hit") / (F.col("support") + F.col("claimed"))
    return per_class.groupBy(*by).agg((F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1"))
