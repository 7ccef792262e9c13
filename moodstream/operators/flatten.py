"""Flatten one level of nested records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Nested properties of a video record that are dropped.
DROPPED = ("contents", "challenges", "duetInfo", "textExtra", "stickersOnItem")


def flatten_record(df: DataFrame, dropped: Sequence[str] = DROPPED) -> DataFrame:
    """Struct columns become ``parent_child`` columns, one level deep; the rest is copied.

    The output columns follow from the schema, so no row is looked at and unread children are
    pruned from the scan.
    """
    out = []
    for field in df.schema.fields:
        if field.name in dropped:
            continue
        if isinstance(field.dataType, T.StructType):
            out += [
                F.col(f"`{field.name}`.`{child}`").alias(f"{field.name}_{child}")
                for child in field.dataType.fieldNames()
            ]
        else:
            out.append(F.col(f"`{field.name}`"))
    return df.select(*out)


def flatten_json(
    df: DataFrame, value: str, schema: T.StructType, dropped: Sequence[str] = DROPPED
) -> DataFrame:
    """Parse JSON records with a known schema and flatten them. Dropped parts are not parsed."""
    wanted = T.StructType([f for f in schema.fields if f.name not in dropped])
    parsed = df.select(F.from_json(F.col(value), wanted).alias("record"))
    return flatten_record(parsed.select("record.*"), dropped)
