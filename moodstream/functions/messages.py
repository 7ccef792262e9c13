"""JSON messages: parse, unnest, and build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream import schemas
from moodstream.functions.binding import let
from moodstream.functions.classes import class_code, class_name


def parsed_message(value: Column) -> Column:
    """``{"comments": [...]}`` as a struct; null where the text is not such JSON.

    Items come out as text, whether the message holds strings, objects or pairs. For duplicate
    keys the last one wins.
    """
    return F.from_json(value, schemas.MESSAGE, {"mode": "PERMISSIVE"})


def split_messages(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good, bad) messages; good ones gain a ``comments`` column.

    Bad means: not JSON, or no ``comments`` array. They can be written to a quarantine table
    instead of ending the job.
    """
    parsed = messages.withColumn("comments", parsed_message(F.col(value)).getField("comments"))
    good = parsed.filter(F.col("comments").isNotNull())
    bad = parsed.filter(F.col("comments").isNull()).drop("comments")
    return good, bad


def unnest(df: DataFrame, array: str, item: str = "item", pos: str | None = "pos") -> DataFrame:
    """One row per array element, with its position unless ``pos`` is None."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != array]
    # A plain explode makes Spark test the array in a filter below, which would compute it again;
    # null and empty arrays are dropped here instead.
    rows = df.select(*rest, F.posexplode_outer(array).alias(pos or "_pos", item))
    kept = rows.filter(F.col(pos or "_pos").isNotNull())
    return kept if pos else kept.drop("_pos")


def pair_comment(item: Column) -> Column:
    """``[UserID, text]`` item, or an object with those names, as a comment struct."""
    as_pair = let(
        F.from_json(item, schemas.PAIR),
        lambda p: F.struct(F.get(p, F.lit(0)).alias("UserID"), F.get(p, F.lit(1)).alias("Sentence")),
    )
    is_pair = F.ltrim(item).startswith("[")
    return F.when(is_pair, as_pair).otherwise(F.from_json(item, schemas.COMMENT))


def scored_comment(item: Column) -> Column:
    """Scored item as a struct; a missing prediction is null.

    The class is the name the item carries, or else that of its prediction code.
    """
    return let(
        F.from_json(item, schemas.SCORED),
        lambda c: F.when(
            c.isNotNull(),
            c.withField("class", F.coalesce(c.getField("class"), class_name(c.getField("prediction")))),
        ),
    )


def published_columns(columns: Sequence[str], available: Sequence[str]) -> list[Column]:
    """The columns of a scored row as others may read them.

    A model numbers its classes by frequency, so its index means nothing outside. Rows that name their
    class send the fixed code of that name as ``prediction`` (null for a name without a code) and the
    name itself; rows without a class send the code they have.
    """
    if "class" not in available:
        return [F.col(c) for c in columns]
    code = class_code(F.col("class")).alias("prediction")
    out = [code if c == "prediction" else F.col(c) for c in columns]
    return out if "class" in columns else [*out, F.col("class")]


def comments_from_messages(
    messages: DataFrame, keep: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """Raw-comment messages to ``(*keep, pos, UserID, Sentence)`` rows; bad ones give none."""
    parsed = parsed_message(F.col(value)).getField("comments").alias("comments")
    items = unnest(messages.select(*keep, parsed), "comments")
    return items.select(*keep, "pos", pair_comment(F.col("item")).alias("c")).select(
        *keep, "pos", "c.UserID", "c.Sentence"
    )


def scored_from_messages(
    messages: DataFrame, keep: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """Scored messages, decoded twice, to ``(*keep, pos, UserID, Sentence, prediction, class)`` rows."""
    parsed = parsed_message(F.col(value)).getField("comments").alias("comments")
    items = unnest(messages.select(*keep, parsed), "comments")
    return items.select(*keep, "pos", scored_comment(F.col("item")).alias("c")).select(
        *keep, "pos", "c.UserID", "c.Sentence", "c.prediction", "c.class"
    )


def row_json(*columns: str | Column) -> Column:
    """The named columns as one JSON object; null fields are left out."""
    return F.to_json(F.struct(*columns))


def message_json(items: Column) -> Column:
    """Array of items wrapped as a ``{"comments": [...]}`` message."""
    return F.to_json(F.struct(items.alias("comments")))
