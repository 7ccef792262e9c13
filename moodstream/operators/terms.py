"""Term statistics in long form: one row per (document, term) or per term."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodstream.functions.text import term_counts
from moodstream.operators.joins import salted_lookup
from moodstream.session import materialise


def dealt(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """The rows dealt by ``key`` over a number of partitions that the caller names, or as they are.

    A table in one small file has one split, so heavy text work on it would use one core; a caller who
    knows that names the partitions. Nothing is decided by size.
    """
    return df.repartition(partitions, key) if partitions else df


def term_frequencies(docs: DataFrame, words: Column, id_col: str = "doc_id") -> DataFrame:
    """``(id, term, tf)``, counted inside each row without a shuffle. Null texts have no terms."""
    return docs.select(id_col, F.inline(term_counts(words)))


def counts_by_id(docs: DataFrame, words: Column, id_col: str = "doc_id") -> DataFrame:
    """``(id, term, tf)`` like ``term_frequencies``, where rows that share an id count as one document.

    Only ids are shuffled to find those that come more than once, null among them. The terms of all other rows are
    counted inside the row; no task holds more of them than one row's.
    """
    again = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1)
    again = materialise(again.select(F.col(id_col).alias("_again")), "repeated-ids")
    met = F.col(id_col).eqNullSafe(F.col("_again"))
    once = term_frequencies(docs.join(again, met, "left_anti"), words, id_col)
    shared = term_frequencies(docs.join(again, met, "left_semi"), words, id_col)
    return once.unionByName(shared.groupBy(id_col, "term").agg(F.sum("tf").alias("tf")))


def term_stats(pairs: DataFrame) -> DataFrame:
    """``(term, term_count, doc_freq)`` over all documents."""
    return pairs.groupBy("term").agg(
        F.sum("tf").alias("term_count"), F.count(F.lit(1)).alias("doc_freq")
    )


def vocabulary(stats: DataFrame, min_doc_freq: int = 5, size: int = 30_000) -> DataFrame:
    """The ``size`` most frequent terms found in at least ``min_doc_freq`` documents."""
    kept = stats.filter(F.col("doc_freq") >= min_doc_freq)
    return kept.orderBy(F.desc("term_count"), F.asc("term")).limit(size)


def inverse_document_frequency(
    stats: DataFrame, docs: DataFrame, min_doc_freq: int = 2
) -> DataFrame:
    """``(term, doc_freq, idf)`` with ``ln((N + 1) / (df + 1))``, or 0 for rarer terms.

    ``docs`` are the documents that have a text, as ``model.with_text`` gives them.
    """
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    weight = F.log((n_docs + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0)))
    return stats.select(
        "term",
        "doc_freq",
        F.when(F.col("doc_freq") >= min_doc_freq, weight).otherwise(F.lit(0.0)).alias("idf"),
    )


def tf_idf(pairs: DataFrame, weights: DataFrame, id_col: str = "doc_id", **skew) -> DataFrame:
    """``(id, term, tf, idf, tfidf)``; frequent terms are salted by document."""
    joined = salted_lookup(pairs, weights, "term", "doc_freq", id_col, **skew)
    return joined.select(
        id_col, "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )
