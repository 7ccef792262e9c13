"""Flatten records whose keys and types nobody has written down.

One distributed pass finds the keys of all records, down to one level, and the types of their values; a second one makes
the columns. The records stay variants in between, so no schema is guessed from a sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.operators.flatten import DROPPED

#: More columns than this are refused: keys that are data, such as ids, would become one column each.
MAX_COLUMNS = 5_000
#: Names of variant types, by the column type that holds all their values; others are written as JSON.
_WHOLE, _REAL = {"BIGINT"}, {"BIGINT", "DOUBLE", "FLOAT", "DECIMAL"}


def _entries(value: Column) -> Column:
    return F.map_entries(value.cast("map<string,variant>"))


def _kind(value: Column) -> Column:
    """First word of a variant's type; null for a JSON null."""
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(kind != "VOID", kind)


def record_keys(records: DataFrame, value: str, dropped: Sequence[str] = DROPPED) -> DataFrame:
    """``(parent, child, kinds)``: every key of every record, with the different types of its values.

    A key whose values are all objects (or missing) is listed by its children; any other key has a null child.
    """
    parsed = records.select(F.try_parse_json(value).alias("v"))
    objects = parsed.filter(F.schema_of_variant("v").startswith("OBJECT"))
    tops = objects.select(F.explode(_entries(F.col("v"))).alias("e")).select(F.col("e.key").alias("parent"), F.col("e.value").alias("v"))
    tops = tops.filter(~F.col("parent").isin(list(dropped))) if dropped else tops
    kinds = tops.withColumn("kind", _kind(F.col("v")))
    inner = F.when(F.col("kind") == "OBJECT", F.transform(_entries(F.col("v")), lambda e: F.struct(e["key"].alias("child"), _kind(e["value"]).alias("kind"))))
    own = F.array(F.struct(F.lit(None).cast("string").alias("child"), F.col("kind").alias("kind")))
    rows = kinds.select("parent", F.inline(F.concat(own, F.coalesce(inner, F.array().cast("array<struct<child:string,kind:string>>")))))
    # Types of a key are few, so the sets stay small; a key that every record has sends one set per task.
    return rows.groupBy("parent", "child").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def _typed(value: Column, kinds: Sequence[str]) -> Column:
    """A variant as the one type that holds all its kinds, else as JSON; text is given as it is where all values are texts."""
    found = set(kinds)
    if found == {"STRING"}:
        return value.cast("string")
    if found == {"BOOLEAN"}:
        return value.cast("boolean")
    if found and found <= _WHOLE:
        return value.cast("bigint")
    if found and found <= _REAL:
        return value.cast("double")
    return F.when(_kind(value).isNotNull(), F.to_json(value))


def flatten_any(records: DataFrame, value: str, dropped: Sequence[str] = DROPPED, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and one column for every key of the JSON records in ``value``, objects as ``parent_child`` columns.

    Columns are in the order of their names. Missing keys and JSON nulls are null. Numbers of different types become
    doubles. Values of clashing types, arrays and objects below the first level become JSON text. A key that holds an
    object in some records and something else in others is one column of JSON text. Should a nested key and a top one
    give one name, the nested one is written with two underscores. Rows that hold no JSON object give nulls. Records
    with a repeated key count as no JSON, as their value is not defined. Without any record there are no columns but
    ``keep``.
    """
    found = record_keys(records, value, dropped).limit(MAX_COLUMNS + 1).collect()
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"the records have more than {MAX_COLUMNS} keys")
    kinds = {(r["parent"], r["child"]): r["kinds"] for r in found}
    nested = {p for p, c in kinds if c is None and set(kinds[p, c]) == {"OBJECT"}}
    tops = {p for p, c in kinds if c is None} - nested
    parsed = F.try_parse_json(value)
    top = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed).cast("map<string,variant>")
    out = {p: _typed(F.col("_top")[p], kinds[p, None]) for p in tops}
    for parent, child in kinds:
        if child is not None and parent in nested:
            name = f"{parent}_{child}"
            name = f"{parent}__{child}" if name in tops else name
            out[name] = _typed(F.col("_top")[parent].cast("map<string,variant>")[child], kinds[parent, child])
    rows = records.select(*keep, top.alias("_top"))
    return rows.select(*keep, *[out[name].alias(name) for name in sorted(out)])
