"""Helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodstream.session import materialise, new_path

__all__ = ["as_int64", "byte_slices", "global_index", "grouped", "materialise", "new_path", "partitions_for", "ship", "table"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once, so that they need no installation."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "moodstream_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def as_int64(column: Column) -> Column:
    """An id as long, null as the smallest long: nulls sort first and still join."""
    return F.coalesce(column.cast("long"), F.lit(-(2**63)))


def partitions_for(amount: int, per_partition: int) -> int:
    """Partitions that keep ``per_partition`` units each at any size."""
    return max(1, -(-int(amount) // per_partition))


def byte_slices(array: pa.Array, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of whole values of about ``most`` bytes.

    Yields first row, end row, the bytes of the run and its row borders (relative to the run).
    """
    array = array.cast(pa.large_binary()) if not pa.types.is_large_binary(array.type) else array
    if not len(array):
        return
    borders = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(array):
        end = int(np.searchsorted(borders, borders[first] + most, "right")) - 1
        end = min(max(end, first + 1), len(array))
        yield first, end, data[borders[first] : borders[end]], borders[first : end + 1] - borders[first]
        first = end


def grouped(
    df: DataFrame, key: str, partitions: int, work: Callable[[pa.Table], Iterator[pa.RecordBatch] | None],
    schema: str, rows: int = 20_000, order: tuple[str, ...] = (),
) -> DataFrame:
    """Apply ``work`` to runs of whole key groups.

    Rows are dealt by ``key`` and sorted, and every call gets one or more complete groups, about
    ``rows`` rows together, so that many small groups cost one call. A group must fit in memory: callers
    bound or split their groups beforehand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) < rows:
                continue
            joined = pa.concat_tables(held)
            keys = joined[key].to_numpy()
            cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
            held = [joined.slice(cut)]
            if cut:
                yield from work(joined.slice(0, cut)) or ()
        if held:
            yield from work(pa.concat_tables(held)) or ()

    return df.repartition(partitions, key).sortWithinPartitions(key, *order).mapInArrow(run, schema)


def global_index(df: DataFrame, order: list[str], name: str = "_index") -> DataFrame:
    """Number all rows from 0 in the given order without a single-task sort.

    Rows are range partitioned and sorted; the sorted rows are written once, then each partition adds
    the number of rows before it.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    # One row per partition: this single-task window grows with the partitions, not with the rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, "_part").withColumn(name, F.col("_start") + local).drop("_at", "_part", "_start")
