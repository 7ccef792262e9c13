"""The most frequent terms from bounded summaries, with a bound that tells when they are certain.

Each task keeps at most a fixed number of counters. When there are more, the largest that must go is taken off all
counters, and those at zero leave: no term loses more than what was taken off. Summaries add up, and so do their
losses, so a merged counter lies at most the total loss below the term's true count. Only terms that can still be among
the most frequent are counted exactly, and the rare ones, nearly all of a vocabulary, are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.functions.text import term_counts
from moodstream.operators import terms
from moodstream.session import materialise, ship_package

#: Counters a task keeps.
CAPACITY = 500_000
#: Up to so many candidates are sent to all tasks; beyond that they are joined by a shuffle.
BROADCAST_TERMS = 200_000


def _added_up(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by("term").aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table({"term": sums["term"], "n": sums["n_sum"], "docs": sums["docs_sum"]})


def _cut(held: pa.Table, capacity: int) -> tuple[pa.Table, int]:
    """At most ``capacity`` counters, and what was taken off each."""
    if held.num_rows <= capacity:
        return held, 0
    last = pc.select_k_unstable(held["n"], capacity + 1, [("", "descending")])[capacity].as_py()
    off = held["n"][last].as_py()
    lowered = held.set_column(1, "n", pc.subtract(held["n"], off))
    return lowered.filter(pc.greater(lowered["n"], 0)), off


def summaries(docs: DataFrame, words: Column, capacity: int = CAPACITY) -> DataFrame:
    """``(term, n, docs)`` of every task's counters, and a row with a null term whose ``n`` is the task's loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"term": pa.array([], pa.string()), "n": pa.array([], pa.int64()), "docs": pa.array([], pa.int64())})
        loss, waiting, rows = 0, [], 0
        for batch in batches:
            pairs = batch.column(0).flatten()
            if not len(pairs):
                continue
            term, tf = pairs.field("term"), pairs.field("tf")
            waiting.append(pa.table({"term": term, "n": tf, "docs": pa.array([1] * len(term), pa.int64())}))
            rows += len(term)
            if rows >= capacity:
                held, off = _cut(_added_up([held, *waiting]), capacity)
                loss, waiting, rows = loss + off, [], 0
        held, off = _cut(_added_up([held, *waiting]), capacity)
        lost = pa.table({"term": pa.array([None], pa.string()), "n": pa.array([loss + off], pa.int64()), "docs": pa.array([0], pa.int64())})
        yield from pa.concat_tables([held, lost]).to_batches(max_chunksize=100_000)

    ship_package(docs.sparkSession)
    return docs.select(term_counts(words).alias("pairs")).filter(F.size("pairs") > 0).mapInArrow(run, "term string, n long, docs long")


@dataclass(frozen=True)
class Candidates:
    """Terms that may be among the most frequent, the bound on what a count can lack, and whether all of them are there."""

    terms: DataFrame
    loss: int
    certain: bool


def candidates(summary: DataFrame, size: int, min_doc_freq: int = 1) -> Candidates:
    """Candidates for the ``size`` most frequent terms among those in ``min_doc_freq`` documents.

    With ``size`` terms known to be in enough documents, and the least of their counters above the loss, a term outside
    the summary is rarer than all of them. Without any loss the summary is complete.
    """
    merged = materialise(summary.groupBy("term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "merged-summaries")
    loss = merged.filter(F.col("term").isNull()).agg(F.sum("n")).first()[0] or 0
    known = merged.filter(F.col("term").isNotNull())
    if not loss:
        return Candidates(known.select("term"), 0, True)
    # The counter of the last place: one row comes back.
    top = known.filter(F.col("docs") >= min_doc_freq).orderBy(F.desc("n"), F.asc("term")).limit(size)
    n, least = top.agg(F.count(F.lit(1)), F.min("n")).first()
    if n < size or least <= loss:
        return Candidates(known.select("term"), loss, False)
    return Candidates(known.filter(F.col("n") + loss >= least).select("term"), loss, True)


def heavy_vocabulary(
    docs: DataFrame, words: Column, min_doc_freq: int = 5, size: int = 30_000, capacity: int = CAPACITY, id_col: str = "doc_id"
) -> DataFrame:
    """As ``terms.vocabulary`` over ``terms.term_stats``, by a bounded summary and an exact count of its candidates.

    Where the bound leaves the result open, all terms are counted. Null texts have no terms; an empty table has no
    vocabulary.
    """
    found = candidates(summaries(docs, words, capacity), size, min_doc_freq)
    pairs = terms.term_frequencies(docs, words, id_col)
    if found.certain:
        listed = materialise(found.terms, "candidates")
        side = F.broadcast(listed) if listed.count() <= BROADCAST_TERMS else listed
        pairs = pairs.join(side, "term", "left_semi")
    return terms.vocabulary(terms.term_stats(pairs), min_doc_freq, size)
