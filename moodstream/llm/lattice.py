"""Embedding near-duplicates by lattice hashing.

Equal vectors of one label collapse first. Unit vectors are projected at random to eight dimensions, several
times over, and decoded to the nearest point of the E8 lattice; each vector also probes the neighbouring cells
nearest to it. Vectors that meet in a cell are verified by cosine and tied into stars, never listed as pairs,
and links are counted exactly within the components that result, in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import as_int64, grouped, materialise, ship
from moodstream.llm.components import components
from moodstream.llm.nearest import usable_rows

LEAST_COSINE = 0.93
TABLES = 16
PROBES = 4
CELL = 0.45
TILE = 512
SEED = 11


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point to each row, in halves (integers): whole points of even sum, or all shifted by a half."""

    def even(y: np.ndarray) -> np.ndarray:
        whole = np.rint(y)
        odd = np.flatnonzero(whole.sum(axis=1) % 2 != 0)
        if len(odd):
            rest = y[odd] - whole[odd]
            worst = np.abs(rest).argmax(axis=1)
            whole[odd, worst] += np.where(rest[np.arange(len(odd)), worst] >= 0, 1, -1)
        return whole

    plain, shifted = even(x), even(x - 0.5) + 0.5
    closer = ((x - plain) ** 2).sum(axis=1) <= ((x - shifted) ** 2).sum(axis=1)
    return np.where(closer[:, None], 2 * plain, 2 * shifted).astype(np.int64)


def _shortest() -> np.ndarray:
    """The 240 shortest E8 vectors, in halves: the steps to a cell's neighbours."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = [0] * 8
                    v[i], v[j] = a, b
                    out.append(v)
    for signs in range(256):
        v = [1 if signs >> k & 1 else -1 for k in range(8)]
        if sum(x < 0 for x in v) % 2 == 0:
            out.append(v)
    return np.array(out, np.int64)


def cells(unit: np.ndarray, tables: int, probes: int, cell: float, seed: int) -> np.ndarray:
    """Hashed cell of each unit vector in each table, own cell first, then the nearest neighbours."""
    dim = unit.shape[1]
    rng = np.random.default_rng(seed)
    steps = _shortest()
    mix = rng.integers(1, 2**63, 8, dtype=np.int64) | 1
    out = np.empty((len(unit), tables, 1 + probes), np.int64)
    for t in range(tables):
        base = rng.normal(size=(dim, 8))
        if dim >= 8:
            base = np.linalg.qr(base)[0] * np.sqrt(dim / 8)
        else:
            # Orthonormal rows: short vectors keep their distances in eight dimensions.
            base = np.linalg.qr(base.T)[0].T
        y = unit @ base / cell + rng.random(8)
        point = nearest_e8(y)
        found = [point]
        if probes:
            # The neighbour along a step is nearer the larger the step's product with the rest.
            toward = (y - point / 2) @ (steps.T / 2)
            top = np.argpartition(-toward, probes - 1, axis=1)[:, :probes]
            found += [point + steps[top[:, k]] for k in range(probes)]
        with np.errstate(over="ignore"):
            for k, p in enumerate(found):
                h = (p * mix).sum(axis=1) + np.int64(t) * mix[0]
                out[:, t, k] = h ^ (h >> 29)
    return out


def _placed(tables: int, probes: int, cell: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vectors = [np.array(v, np.float64) for v in batch.column(2).to_pylist()]
            sizes = np.array([len(v) for v in vectors])
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                for s in range(0, len(at), 1000):
                    some = at[s : s + 1000]
                    x = np.stack([vectors[i] for i in some])
                    found = cells(x / np.linalg.norm(x, axis=1)[:, None], tables, probes, cell, seed)
                    with np.errstate(over="ignore"):
                        key = found.reshape(len(some), -1) ^ (labels[some] * np.int64(0x5851F42D4C957F2D) + dim)[:, None]
                    yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(names[some], key.shape[1]))], names=["key", "r"])

    return run


def tiled(rows: DataFrame, key: str, size: int = TILE) -> DataFrame:
    """Deal the groups of ``key`` into tiles of about twice ``size`` rows in which all pairs of a group meet once.

    Adds ``tile`` and ``side``: rows of side 2 meet each other, rows of side 0 meet those of side 1. Groups of
    one row are left out.
    """
    counted = rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / size).cast("int")
    dealt = rows.join(counted, key).withColumn("_b", F.pmod(F.xxhash64("r"), blocks).cast("int"))
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), blocks - 1)))
    side = F.when(F.col("_b") == F.col("_o"), 2).when(F.col("_b") < F.col("_o"), 0).otherwise(1)
    tile = F.xxhash64(key, F.least("_b", "_o"), F.greatest("_b", "_o"))
    return dealt.withColumn("tile", tile).withColumn("side", side).drop("_n", "_b", "_o")


def _unit_groups(rows: pa.Table):
    """Row numbers, sides and unit vectors of every tile of a table sorted by tile, by vector length."""
    tiles = rows["tile"].to_numpy()
    vectors = rows["vector"].to_pylist()
    sides = rows["side"].to_numpy()
    borders = np.append(np.flatnonzero(np.concatenate([[True], tiles[1:] != tiles[:-1]])), len(tiles))
    for a, b in zip(borders[:-1], borders[1:]):
        sizes = np.array([len(v) for v in vectors[a:b]])
        for dim in np.unique(sizes):
            at = a + np.flatnonzero(sizes == dim)
            if len(at) > 1:
                x = np.array([vectors[i] for i in at], np.float64)
                yield at, sides[at], x / np.linalg.norm(x, axis=1)[:, None]


def _linked(side: np.ndarray, unit: np.ndarray, least: float) -> np.ndarray:
    close = unit @ unit.T >= least
    np.fill_diagonal(close, False)
    return close & ((side[:, None] == 2) & (side[None, :] == 2) | (side[:, None] + side[None, :] == 1))


def _tie(least: float):
    """Stars over the linked components inside each tile."""

    def work(rows: pa.Table):
        names = rows["r"].to_numpy()
        a, b = [], []
        for at, side, unit in _unit_groups(rows):
            close = _linked(side, unit, least)
            root = np.arange(len(at))
            while True:
                spread = np.where(close, root[None, :], len(at)).min(axis=1, initial=len(at))
                lower = np.minimum(root, spread)
                lower = lower[lower]
                if (lower == root).all():
                    break
                root = lower
            tied = np.flatnonzero(root != np.arange(len(at)))
            a.append(names[at[tied]])
            b.append(names[at[root[tied]]])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return work


def _count(least: float):
    """Linked rows of each vector inside each tile, copies counted."""

    def work(rows: pa.Table):
        names, copies = rows["r"].to_numpy(), rows["copies"].to_numpy()
        out, links = [], []
        for at, side, unit in _unit_groups(rows):
            out.append(names[at])
            links.append(_linked(side, unit, least) @ copies[at])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(np.concatenate(links))], names=["r", "links"])

    return work


def embedding_links(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    least: float = LEAST_COSINE, tables: int = TABLES, probes: int = PROBES, cell: float = CELL, tile: int = TILE,
) -> DataFrame:
    """One row per input row: the id, ``n_links``, ``component_id``, ``kept``.

    Vectors link when their labels are equal and not null and their cosine is at least ``least``. Vectors that are
    null, empty, zero or have null or non-finite components, and rows without id or label, link with nothing.
    Lengths do not mix. Rows with equal label and vector are linked to each other, repeated ids included;
    ``component_id`` is the smallest id reachable. Other columns are ignored.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).cast("long").alias("label"))
    able = slim.where("label is not null").select(as_int64(F.col("id")).alias("i"), "label", "vector")
    good = able.mapInArrow(usable_rows, "i long, label long, vector array<double>")
    classes = materialise(
        good.groupBy("label", "vector").agg(F.min("i").alias("first"), F.count("*").alias("copies")).withColumn("r", F.monotonically_increasing_id()), "vectors"
    )
    placed = classes.select("r", "label", "vector").mapInArrow(_placed(tables, probes, cell, SEED), "key long, r long").distinct()
    placed = materialise(placed, "cells")
    shared = placed.groupBy("key").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).where("lo < hi").select("key")
    met = placed.join(shared, "key", "left_semi").join(classes.select("r", "vector"), "r")
    links = grouped(tiled(met, "key", tile).select("tile", "side", "r", "vector"), "tile", parts, _tie(least), "a long, b long", rows=4 * tile)
    roots = materialise(components(links).withColumnsRenamed({"v": "r"}), "roots")
    member = classes.join(roots, "r", "left").withColumn("root", F.coalesce("root", "r"))
    inner = roots.unionByName(roots.select(F.col("root").alias("r"), "root").distinct()).join(classes.select("r", "vector", "copies"), "r")
    counts = grouped(tiled(inner, "root", tile).select("tile", "side", "r", "vector", "copies"), "tile", parts, _count(least), "r long, links long", rows=4 * tile)
    total = counts.groupBy("r").agg(F.sum("links").alias("links"))
    least_id = member.groupBy("root").agg(F.min("first").alias("component"))
    known = member.join(total, "r", "left").join(least_id, "root").select(
        F.col("label").alias("l"), F.col("vector").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component"
    )
    out = slim.join(known, (slim["label"] == known["l"]) & (slim["vector"] == known["v"]), "left")
    # A null id stands as the smallest long inside; it comes back as null.
    shown = F.when(F.col("component") == F.lit(-(2**63)), None).otherwise(F.col("component"))
    own = F.col("n_links").isNull()
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(own, F.col("id").cast("long")).otherwise(shown).alias("component_id"),
        F.when(own, True).otherwise(as_int64(F.col("id")) == F.col("component")).alias("kept"),
    )


def op9(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate links of all embeddings with equal labels."""
    ship(spark)
    return embedding_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
