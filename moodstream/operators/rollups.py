"""Counts per class: distribution, per batch, running, totals and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodstream.functions.classes import CLASSES


def class_distribution(df: DataFrame, column: str = "class") -> DataFrame:
    """Rows per value, largest first; null is a group of its own, ties in name order."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))


def class_counters(column: str = "class") -> list[Column]:
    """One conditional count per class."""
    return [F.count_if(F.col(column) == c).alias(c) for c in CLASSES]


def class_counts_by_batch(df: DataFrame, batch: str, column: str = "class") -> DataFrame:
    """One row per batch with a counter per class. Partial counts are made before the shuffle."""
    return df.groupBy(batch).agg(*class_counters(column))


def running_totals(
    counts: DataFrame, batch: str, block: Column, columns: Sequence[str] = CLASSES
) -> DataFrame:
    """Cumulative counters in batch order.

    ``counts`` has one row per batch and ``block`` groups neighbouring batches (for example by
    day). Totals run inside each block in parallel; only one row per block is summed in global
    order, and its total so far is added to the block's batches.
    """
    blocks = counts.withColumn("_block", block)
    inside = Window.partitionBy("_block").orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    within = blocks.select(
        "_block", batch, *[F.sum(c).over(inside).alias(c) for c in columns]
    )
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocks.groupBy("_block")
        .agg(*[F.sum(c).alias(c) for c in columns])
        .select(
            "_block",
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in columns],
        )
    )
    # A left join adds no null filter to one side only, so both sides share one scan and shuffle.
    return within.join(carried, "_block", "left").select(
        batch, *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in columns]
    )


def grand_totals(df: DataFrame, column: str = "class") -> DataFrame:
    """One row: counted comments in all and per class. Rows without a class do not count."""
    return df.agg(F.count(column).alias("total"), *class_counters(column))


def user_totals(df: DataFrame, user: str = "UserID", column: str = "class") -> DataFrame:
    """Comment counts and distinct users, in all and per class.

    The ``comments_*`` numbers count every comment, the ``users_*`` numbers every user once. Rows
    are first reduced to one per user, so no distinct set is ever held for a class.
    """
    per_user = (
        df.filter(F.col(column).isNotNull())
        .groupBy(user)
        .agg(F.count(F.lit(1)).alias("total"), *class_counters(column))
    )
    names = ("total", *CLASSES)
    return per_user.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"comments_{c}") for c in names],
        *[F.count_if((F.col(c) > 0) & F.col(user).isNotNull()).alias(f"users_{c}") for c in names],
    )


def user_totals_approx(
    df: DataFrame, user: str = "UserID", column: str = "class", rsd: float = 0.05
) -> DataFrame:
    """Distinct users per class from sketches of fixed size: no shuffle of user ids."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("comments"), F.approx_count_distinct(user, rsd).alias("users")
    )


def _with_share(counts: DataFrame, column: str) -> DataFrame:
    # One row per class, so this window holds a handful of rows.
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(column, "n", F.round(100 * F.col("n") / total, 1).alias("pct"))


def class_share(df: DataFrame, column: str = "class") -> DataFrame:
    """Rows and percent of the total per class, one decimal, halves rounded up."""
    known = df.filter(F.col(column).isNotNull())
    return _with_share(known.groupBy(column).agg(F.count(F.lit(1)).alias("n")), column)


def share_of_batches(counts: DataFrame, column: str = "class") -> DataFrame:
    """``class_share`` from counters per batch, without reading the comments again."""
    totals = counts.agg(*[F.sum(c).alias(c) for c in CLASSES])
    pairs = F.array(*[F.struct(F.lit(c).alias(column), F.col(c).alias("n")) for c in CLASSES])
    return _with_share(totals.select(F.inline(pairs)).filter(F.col("n") > 0), column)


def negative_users(df: DataFrame, user: str = "UserID", column: str = "class") -> DataFrame:
    """User id of every negative comment; a user appears once per comment."""
    return df.filter(F.col(column) == "negative").select(user)


def negative_user_counts(df: DataFrame, user: str = "UserID", column: str = "class") -> DataFrame:
    """Each user with negative comments once, with their number."""
    return negative_users(df, user, column).groupBy(user).agg(F.count(F.lit(1)).alias("n"))
