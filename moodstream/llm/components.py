"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import materialise


def _stars(directed: DataFrame, upward: bool) -> DataFrame:
    """Tie neighbours of each vertex ``u`` to the least vertex around it."""
    least = directed.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = directed.join(least, "u")
    if upward:
        joined = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        joined = joined.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
    return joined.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Least vertex of the component of every linked vertex: ``v``, ``root``.

    ``links`` has long columns ``a`` and ``b``; order, repetitions and loops do not matter. Every round
    writes its links to the shared folder; the driver sees only a count and a checksum.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
        seen = state
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _stars(both, True)
        edges = materialise(_stars(large.select(F.col("a").alias("u"), F.col("b").alias("v")), False), "links")
