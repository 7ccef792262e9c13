"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised at its own approximate quantiles, the cells are numbered along the curve, and the
rows in curve order are cut into runs of equal row counts. Rows near each other in every dimension share a shard,
so a reader can skip shards by any of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from moodstream.llm.common import as_int64, global_index, ship

BITS = 5
SHARDS = 24


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of cell numbers below ``2 ** bits``.

    The axes are turned and flipped from the highest bit down, then the transposed Gray code is read out.
    """
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in range(n):
            turned = (x[:, axis] & bit) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, axis]) & low)
            x[:, 0] = np.where(turned, x[:, 0] ^ low, x[:, 0] ^ swap)
            x[:, axis] ^= swap
    for axis in range(1, n):
        x[:, axis] ^= x[:, axis - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, n - 1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= flip[:, None]
    out = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            out = (out << 1) | ((x[:, axis] >> level) & 1)
    return out


def _as_number(df: DataFrame, name: str) -> Column:
    """Numbers as they are, other values by the order of their first seven bytes."""
    if isinstance(df.schema[name].dataType, NumericType):
        return F.col(name).cast("double")
    prefix = F.rpad(F.hex(F.substring(F.col(name).cast("string").cast("binary"), 1, 7)), 14, "0")
    return F.conv(prefix, 16, 10).cast("double")


def shard_by_curve(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: tuple[str, ...] = ("lang", "source", "n_chars"),
    shards: int = SHARDS, bits: int = BITS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Shard and place of every row: the id, columns in ``keep``, ``size``, ``text_crc32``, ``curve``, ``shard``, ``slot``.

    ``size`` is the text's UTF-8 length plus 8, a null text having none. Row counts of shards differ by at most
    one. Null metadata has the lowest cell; rows of one cell are ordered by text checksum and id, so equal texts of one cell
    stay together. Repeated rows keep a slot each; other columns are ignored.
    """
    binary = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    slim = docs.select(
        F.struct(F.col(id_col).alias("_id"), *[F.col(c) for c in keep]).alias("row"), as_int64(F.col(id_col)).alias("d"),
        (F.octet_length(binary) + 8).cast("long").alias("size"), F.crc32(binary).alias("crc"),
        *[_as_number(docs, c).alias(f"x{i}") for i, c in enumerate(dimensions)],
    )
    names = [f"x{i}" for i in range(len(dimensions))]
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = docs.select(*[_as_number(docs, c).alias(n) for n, c in zip(names, dimensions)])
    cuts = numbers.agg(*[F.percentile_approx(n, steps, 10_000).alias(n) for n in names]).first()

    def number(batches):
        for batch in batches:
            cells = np.stack([
                np.where(np.isnan(v), 0, np.searchsorted(np.array(cuts[n] or []), v, "left"))
                for n in names for v in [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False).astype(float)]
            ], axis=1)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(curve_index(cells, bits))], names=["row", "d", "size", "crc", "curve"])

    kind = slim.schema["row"].dataType.simpleString()
    placed = slim.mapInArrow(number, f"row {kind}, d long, size long, crc long, curve long")
    indexed = global_index(placed, ["curve", "crc", "d", "size"], "i")
    total = indexed.count()
    shard = F.floor(F.col("i") * shards / F.lit(max(total, 1)))
    # Integer arithmetic: doubles would round at large row counts.
    shard = F.expr(f"cast((cast(i as decimal(38,0)) * {shards}) div {max(total, 1)} as int)")
    first = F.expr(f"cast((cast(shard as decimal(38,0)) * {total} + {shards - 1}) div {shards} as long)")
    return indexed.withColumn("shard", shard).withColumn("slot", F.col("i") - first).select(
        F.col("row").getField("_id").alias(id_col), *[F.col("row").getField(c).alias(c) for c in keep],
        "size", F.col("crc").alias("text_crc32"), "curve", "shard", "slot",
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the rows of ``docs`` in one folder per shard, in slot order."""
    id_col = options.get("id_col", "doc_id")
    rest = tuple(c for c in docs.columns if c != id_col)
    sharded = shard_by_curve(docs, keep=rest, **options).select(*docs.columns, "shard", "slot")
    count = options.get("shards", SHARDS)
    sharded.repartition(count, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op7(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts along the curve."""
    ship(spark)
    out = shard_by_curve(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
