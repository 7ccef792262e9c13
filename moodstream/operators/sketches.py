"""Distinct users over time from mergeable sketches, one for each batch and class.

A sketch has a fixed size, and sketches of any batches merge into that of all their rows. So a batch is read once, and
the distinct users of any range of batches come from its sketches.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Logarithm of the number of registers; a sketch has half as many bytes to as many bytes.
REGISTERS = 12


def relative_error(registers: int = REGISTERS, deviations: float = 3.0) -> float:
    """Bound on the relative error of a merged estimate, in standard deviations of 1.04 over the root of the registers."""
    return deviations * 1.04 / sqrt(1 << registers)


def user_sketches(df: DataFrame, batch: str, user: str = "UserID", column: str = "class", registers: int = REGISTERS) -> DataFrame:
    """``(batch, class, comments, users)``: rows, and the sketch of distinct users, of every batch and class.

    Rows without a class do not count, and a null user counts as a comment only. Tasks sketch their own rows, so a batch
    or a class that holds most rows sends one sketch per task.
    """
    known = df.filter(F.col(column).isNotNull())
    return known.groupBy(batch, column).agg(F.count(F.lit(1)).alias("comments"), F.hll_sketch_agg(user, registers).alias("users"))


def users_of(sketch: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))


def users_in_range(sketches: DataFrame, batch: str, first, last, column: str = "class") -> DataFrame:
    """``(class, comments, users)`` of the batches from ``first`` to ``last``, both included."""
    some = sketches.filter(F.col(batch).between(F.lit(first), F.lit(last)))
    return some.groupBy(column).agg(F.sum("comments").alias("comments"), users_of(F.hll_union_agg("users")).alias("users"))


def running_users(sketches: DataFrame, batch: str, block: Column, column: str = "class") -> DataFrame:
    """``(batch, class, comments, users)`` from the start up to every batch that has the class.

    ``block`` groups neighbouring batches, as in ``rollups.running_totals``: prefixes are merged inside the blocks of
    a class in parallel, and only one sketch per block and class goes through all earlier blocks.
    """
    blocks = sketches.withColumn("_block", block)
    inside = Window.partitionBy(column, "_block").orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    within = blocks.select("_block", batch, column, F.sum("comments").over(inside).alias("comments"), F.hll_union_agg("users").over(inside).alias("users"))
    before = Window.partitionBy(column).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = blocks.groupBy(column, "_block").agg(F.sum("comments").alias("c"), F.hll_union_agg("users").alias("u"))
    carried = whole.select(column, "_block", F.sum("c").over(before).alias("_comments"), F.hll_union_agg("u").over(before).alias("_users"))
    met = within.join(carried, [column, "_block"])
    merged = F.when(F.col("_users").isNull(), F.col("users")).otherwise(F.hll_union("users", "_users"))
    return met.select(batch, column, (F.col("comments") + F.coalesce("_comments", F.lit(0))).alias("comments"), users_of(merged).alias("users"))


def running_users_exact(df: DataFrame, batch: str, block: Column, user: str = "UserID", column: str = "class") -> DataFrame:
    """``(batch, class, users)``: distinct users from the start up to every batch that has the class, exactly.

    A user counts in the batch that first has them, so one row per user and class is dealt by user, and the rest are
    sums: per batch, then along the batches by blocks.
    """
    known = df.filter(F.col(column).isNotNull())
    seen = known.groupBy(column, user).agg(F.min(batch).alias(batch)).filter(F.col(user).isNotNull())
    new = seen.groupBy(batch, column).agg(F.count(F.lit(1)).alias("new"))
    every = known.groupBy(batch, column).agg(F.lit(0).cast("long").alias("new"))
    steps = new.unionByName(every).groupBy(batch, column).agg(F.sum("new").alias("new")).withColumn("_block", block)
    inside = Window.partitionBy(column, "_block").orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    within = steps.select("_block", batch, column, F.sum("new").over(inside).alias("users"))
    before = Window.partitionBy(column).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = steps.groupBy(column, "_block").agg(F.sum("new").alias("n"))
    carried = whole.select(column, "_block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_users"))
    return within.join(carried, [column, "_block"]).select(batch, column, (F.col("users") + F.col("_users")).alias("users"))
