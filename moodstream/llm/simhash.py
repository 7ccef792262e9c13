"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprints sum the bits of all shingle hashes. Equal fingerprints collapse first. Structured masks then
place each fingerprint in ``2^(radius+1) - 1`` tables so that every pair within the radius agrees under some
mask, that is, lies in one bucket of some table. The fingerprints of a bucket are compared with each other. A bucket of
too many is not listed: within it, two fingerprints are within two bits exactly when they share a neighbour one
flip away, or one is such a neighbour, and as only 65 fingerprints can share it, linking through these neighbours has
no hot group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodstream.llm.common import as_int64, materialise, ship
from moodstream.llm.components import components

WORDS = 3
RADIUS = 2
SEED = 42
#: Fingerprints of a bucket that are compared each with each other.
LISTED = 64


def fingerprints_of(texts: list[bytes], words: int, seed: int) -> np.ndarray:
    """One 64-bit fingerprint for each text; no word gives zero."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        parts = text.lower().split()
        if not parts:
            continue
        if len(parts) <= words:
            hashes.append(digest(b" ".join(parts), seed))
            counts[i] = 1
            continue
        joined = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = np.concatenate([[0], ends[:-1]])[: len(parts) - words + 1].tolist()
        stops = (ends[words - 1 :] - 1).tolist()
        hashes += [digest(joined[a:b], seed) for a, b in zip(starts, stops)]
        counts[i] = len(starts)
    out = np.zeros(len(texts), np.uint64)
    have = np.flatnonzero(counts)
    if not len(have):
        return out
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    first = np.concatenate([[0], np.cumsum(counts[have])])
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for k, i in enumerate(have):
        bits = np.unpackbits(raw[first[k] : first[k + 1]], axis=1, bitorder="little")
        ones = np.add.reduce(bits, axis=0, dtype=np.uint32)
        out[i] = powers[2 * ones > counts[i]].sum()
    return out


def _fingerprinted(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [t or b"" for t in part.column(1).cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints_of(texts, words, seed).view(np.int64))], names=["row", "f"])

    return run


def masks(radius: int, bits: int = 64) -> list[int]:
    """Masks such that any two values that differ in at most ``radius`` bits agree under one of them.

    Every bit position gets a non-zero vector of ``radius + 1`` bits; mask v keeps the positions whose vector
    has an odd product with v. At most ``radius`` differing positions span too little to be odd under all v.
    """
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if bin(vectors[i] & v).count("1") % 2) for v in range(1, size)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_links(prints: DataFrame, radius: int = RADIUS, largest: int = LISTED) -> DataFrame:
    """Links ``a``, ``b`` that join all distinct fingerprints (column ``f``) within ``radius`` bits, at most 2.

    Buckets of at most ``largest`` fingerprints give all their close pairs. In larger ones not every close pair is listed,
    but the components are those of all close pairs.
    """
    if radius not in (0, 1, 2):
        raise ValueError("the radius is 0, 1 or 2")
    distinct = prints.select("f").distinct()
    if radius == 0:
        return distinct.select(F.col("f").alias("a"), F.col("f").alias("b")).limit(0)
    tables = F.array(*[F.struct(F.lit(k).alias("k"), F.col("f").bitwiseAND(F.lit(_signed(m))).alias("m")) for k, m in enumerate(masks(radius))])
    placed = materialise(distinct.select("f", F.explode(tables).alias("t")).select("f", "t.k", "t.m"), "tables")
    sizes = materialise(placed.groupBy("k", "m").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    small = placed.join(sizes.where(F.col("n") <= largest), ["k", "m"], "left_semi")
    listed = small.groupBy("k", "m").agg(F.collect_list("f").alias("fs"))
    close = F.flatten(F.transform("fs", lambda a: F.transform(
        F.filter("fs", lambda b: (b < a) & (F.bit_count(a.bitwiseXOR(b)) <= radius)), lambda b: F.struct(a.alias("a"), b.alias("b"))
    )))
    pairs = listed.select(F.inline(close).alias("a", "b"))
    crowd = placed.join(sizes.where(F.col("n") > largest), ["k", "m"], "left_semi")
    return pairs.unionByName(_by_neighbours(crowd, radius)).distinct()


def _by_neighbours(crowd: DataFrame, radius: int) -> DataFrame:
    """Links within buckets that are too large to be listed."""
    if radius == 1:
        # One flip apart: equal once the differing bit is cleared.
        hubs = F.array(*[F.struct(F.lit(i).alias("i"), F.col("f").bitwiseAND(F.lit(_signed((1 << 64) - 1 - (1 << i)))).alias("h")) for i in range(64)])
    else:
        hubs = F.array(F.struct(F.lit(0).alias("i"), F.col("f").alias("h")), *[F.struct(F.lit(0).alias("i"), F.col("f").bitwiseXOR(F.lit(_signed(1 << i))).alias("h")) for i in range(64)])
    around = crowd.select("f", "k", "m", F.explode(hubs).alias("x")).select("f", "k", "m", "x.i", "x.h")
    # At most 65 fingerprints meet at one neighbour, so this list is bounded.
    met = around.groupBy("k", "m", "i", "h").agg(F.min("f").alias("b"), F.collect_list("f").alias("all")).where("size(all) > 1")
    return met.select(F.explode("all").alias("a"), "b").where("a <> b")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Fingerprint and component of every row: the id, columns in ``keep``, ``fingerprint``, ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` differing bits, the row's
    own included; null ids count as smaller than all others. Null texts are empty, and texts without a word
    have the fingerprint zero. Repeated rows share a component. Other columns are ignored.
    """
    source = docs.select(F.struct(F.col(id_col).alias("_id"), *[F.col(c) for c in keep]).alias("row"), F.col(text_col).alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    printed = materialise(source.mapInArrow(_fingerprinted(words, SEED), f"row {kind}, f long"), "prints")
    least = materialise(printed.groupBy("f").agg(F.min(as_int64(F.col("row").getField("_id"))).alias("least")), "classes")
    roots = components(near_links(least, radius))
    labelled = least.join(roots.withColumnRenamed("v", "f"), "f", "left").withColumn("root", F.coalesce("root", "f"))
    of_root = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = labelled.join(of_root, "root").select("f", F.expr(f"nullif(component_id, {-(2**63) + 1} - 1)").alias("component_id"))
    return printed.join(of_print, "f").select(
        F.col("row").getField("_id").alias(id_col), *[F.col("row").getField(c).alias(c) for c in keep],
        F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id",
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """All columns of one row of each component: the one with the smallest id, one of several equal rows."""
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_hash.alias("h"))
    groups = simhash_groups(slim, "id", "text", words, radius, keep=("h",))
    first = groups.groupBy(as_int64(F.col("component_id")).alias("c")).agg(F.min(F.struct(as_int64(F.col("id")).alias("d"), "h")).alias("x")).select("x.*")
    kept = docs.select(F.struct("*").alias("row"), as_int64(F.col(id_col)).alias("d"), text_hash.alias("h")).join(first, ["d", "h"], "left_semi")
    nth = F.row_number().over(Window.partitionBy("d", "h").orderBy("d"))
    return kept.withColumn("nth", nth).where("nth = 1").select("row.*")


def op5(spark, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    ship(spark)
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
