"""Exact nearest neighbours by a block matrix join.

Queries and candidates are packed in blocks. For each pair of blocks an int8 product gives all inner products
with a bound on the quantisation error; what could still be among the best is computed again in double
precision, and the best of all blocks are merged by heaps.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import grouped, materialise, partitions_for, ship

QUERY_ROWS = 512
CANDIDATE_ROWS = 2048
FAN = 64
BEST = 20


def usable(id_col: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows whose vector is not null, empty or zero and has finite components only, with those vectors."""
    rows, out = [], []
    for i, v in enumerate(vectors.to_pylist()):
        if v and id_col[i].is_valid and None not in v:
            x = np.array(v, np.float64)
            if np.isfinite(x).all() and x.any():
                rows.append(i)
                out.append(x)
    return np.array(rows, np.int64), out


def usable_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of an id (first column) and a usable vector (last column)."""
    for batch in batches:
        rows, _ = usable(batch.column(0), batch.column(batch.num_columns - 1))
        yield batch.take(pa.array(rows, pa.int64()))


def _blocked(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        made = 0

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made
            rows = held.pop(dim)
            name = (TaskContext.get().partitionId() << 32) + made
            made += 1
            ids = np.array([r[0] for r in rows], np.int64)
            vectors = np.stack([r[1] for r in rows])
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary())],
                names=["block", "dim", "ids", "vectors"],
            )

        for batch in batches:
            ids = batch.column(0)
            rows, vectors = usable(ids, batch.column(1))
            for i, x in zip(rows.tolist(), vectors):
                held.setdefault(len(x), []).append((ids[i].as_py(), x))
                if len(held[len(x)]) == size:
                    yield block(len(x))
        for dim in list(held):
            yield block(dim)

    return run


def _quantised(x: np.ndarray):
    """Integer values, scale, error norm of the quantised vectors and norm of the original ones."""
    scale = np.abs(x).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    whole = np.rint(x / scale[:, None])
    return whole.astype(np.int8), scale, np.linalg.norm(x - whole * scale[:, None], axis=1), np.linalg.norm(x, axis=1)


def block_best(query_ids, queries, ids, vectors, best: int, floor: np.ndarray | None = None):
    """Query row, candidate row and exact inner product of the ``best`` candidates of each query in one block pair.

    ``floor`` has a score for each query that a candidate must reach, found in earlier blocks.
    """
    q, qs, qe, qn = _quantised(queries)
    c, cs, ce, cn = _quantised(vectors)
    # Products of int8 values summed in floats are exact up to 2^24 (1,040 dimensions); beyond, in doubles.
    kind = np.float32 if queries.shape[1] <= 1040 else np.float64
    near = (q.astype(kind) @ c.astype(kind).T).astype(np.float64) * qs[:, None] * cs[None, :]
    slack = (qe[:, None] * cn[None, :] + (qn + qe)[:, None] * ce[None, :]) * (1 + 1e-9) + 1e-12 * qn[:, None] * cn[None, :]
    own = query_ids[:, None] == ids[None, :]
    low = np.where(own, -np.inf, near - slack)
    take = min(best, len(ids))
    least = np.partition(low, len(ids) - take, axis=1)[:, len(ids) - take]
    if floor is not None:
        least = np.maximum(least, floor)
    row, col = np.nonzero((near + slack >= least[:, None]) & ~own)
    # Components are added in their order, as a plain loop would.
    score = np.zeros(len(row))
    for k in range(queries.shape[1]):
        score += queries[row, k] * vectors[col, k]
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    keep = nth < best
    return row[keep], col[keep], score[keep]


class _Best:
    """The best candidates of a query block so far."""

    def __init__(self, ids: np.ndarray, best: int):
        self.ids, self.best = ids, best
        self.row, self.vec, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def floor(self) -> np.ndarray:
        out = np.full(len(self.ids), -np.inf)
        last = np.flatnonzero(np.append(self.row[1:] != self.row[:-1], True)) if len(self.row) else self.row
        full = last[np.bincount(self.row, minlength=len(self.ids))[self.row[last]] == self.best] if len(last) else last
        out[self.row[full]] = self.score[full]
        return out

    def add(self, row, vec, score) -> None:
        row, vec, score = np.append(self.row, row), np.append(self.vec, vec), np.append(self.score, score)
        order = np.lexsort((vec, -score, row))
        row, vec, score = row[order], vec[order], score[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < self.best
        self.row, self.vec, self.score = row[keep], vec[keep], score[keep]

    def rows(self, group: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[self.row]), pa.array(self.vec), pa.array(self.score), pa.array(np.full(len(self.row), group, np.int64))],
            names=["query_id", "vec_id", "score", "part"],
        )


def _tiles(best: int):
    """Block pairs to the best of each query; pairs of one query block that follow each other give one list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Best | None = None
        at = None
        for batch in batches:
            for block, group, dim, q_ids, q, ids, c in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if (block, group) != at:
                    if held is not None:
                        yield held.rows(at[1])
                    held, at = _Best(np.frombuffer(q_ids, np.int64), best), (block, group)
                ids = np.frombuffer(ids, np.int64)
                q, c = np.frombuffer(q).reshape(-1, dim), np.frombuffer(c).reshape(-1, dim)
                row, col, score = block_best(held.ids, q, ids, c, best, held.floor())
                held.add(row, ids[col], score)
        if held is not None:
            yield held.rows(at[1])

    return run


def _merge(best: int):
    """Keep the best of each key by a heap; rows arrive sorted by key."""

    def work(rows: pa.Table):
        keys = rows["key"].to_numpy()
        query, vec, score, part = (rows[n].to_numpy() for n in ("query_id", "vec_id", "score", "part"))
        borders = np.append(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])), len(keys))
        kept, rank = [], []
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist()):
            # A hash key may hold two queries; they are told apart here.
            for one in np.unique(query[a:b]).tolist():
                mine = (a + np.flatnonzero(query[a:b] == one)).tolist()
                top = heapq.nsmallest(best, mine, key=lambda i: (-score[i], vec[i]))
                kept += top
                rank += range(1, len(top) + 1)
        kept = np.array(kept, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query[kept]), pa.array(np.array(rank, np.int32)), pa.array(vec[kept]), pa.array(score[kept]), pa.array(part[kept])],
            names=["query_id", "rank", "vec_id", "score", "part"],
        )

    return work


def nearest(queries: DataFrame, candidates: DataFrame, best: int = BEST, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``best`` candidates of each query by inner product: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Exact for all queries. A candidate with the query's own id is left out; ties go to the smaller id. Rows with a
    null id, or whose vector is null, empty, zero or has null or non-finite components, take no part, and only
    vectors of one length are compared. Candidate rows repeated under one id are separate candidates; a query
    repeated under one id gets one list, that of its smallest usable vector. Other columns are ignored.
    """
    schema = "block long, dim int, ids binary, vectors binary"

    def blocks(df: DataFrame, size: int) -> DataFrame:
        slim = df.select(F.col(id_col).cast("long").alias("i"), F.col(vector_col).alias("v"))
        return materialise(slim.mapInArrow(_blocked(size), schema), "blocks")

    asking = queries.select(F.col(id_col).cast("long").alias(id_col), F.col(vector_col).cast("array<double>").alias(vector_col))
    able = asking.mapInArrow(usable_rows, asking.schema)
    one_each = able.groupBy(id_col).agg(F.min(vector_col).alias(vector_col))
    asked, offered = blocks(one_each, QUERY_ROWS), blocks(candidates, CANDIDATE_ROWS)
    # Candidate blocks form groups of at most about FAN, and as many as there are cores at least. Each query block
    # visits every group, so every pair of blocks meets once, and a visit gives one list for each query.
    blocks_in = max(1, offered.count())
    groups = max(partitions_for(blocks_in, FAN), min(blocks_in, candidates.sparkSession.sparkContext.defaultParallelism))
    left = asked.select(
        F.col("block").alias("qb"), F.col("dim").alias("qd"), F.col("ids").alias("qi"), F.col("vectors").alias("qv"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
    )
    right = offered.select("dim", "ids", "vectors", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("h"))
    pairs = left.join(right, (left["g"] == right["h"]) & (left["qd"] == right["dim"])).select("qb", F.col("g").cast("long").alias("g"), "dim", "qi", "qv", "ids", "vectors")
    found = pairs.mapInArrow(_tiles(best), "query_id long, vec_id long, score double, part long")
    out = "query_id long, rank int, vec_id long, score double, part long"
    parts = groups
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        # Lists of up to FAN blocks are merged at a time, so no group grows with the candidates.
        parts = partitions_for(parts, FAN)
        part = F.pmod("part", F.lit(parts))
        keyed = found.select("query_id", "vec_id", "score", part.alias("part")).withColumn("key", F.xxhash64("query_id", "part"))
        found = grouped(keyed, "key", tasks, _merge(best), out)
        if parts == 1:
            return found.drop("part")


def op8(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of every vector whose id is divisible by 20."""
    ship(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors.where("vec_id % 20 = 0"), vectors)
