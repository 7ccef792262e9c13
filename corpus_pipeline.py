"""Corpus pipeline: quality, near-duplicates, repeated passages, packing.

Every stage takes the documents its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm import packing, quality, simhash, suffix_dedup
from moodstream.llm.common import materialise, ship

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of ``sf_dir``, predicts to be good."""
    ship(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rest = tuple(c for c in docs.columns if c != "doc_id")
    return quality.score(docs, model, keep=rest).where("predicted = 1").select(*docs.columns)


def keep_one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within two bits over 3-word shingles."""
    ship(spark)
    return simhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes that start earlier elsewhere."""
    ship(spark)
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    kept = suffix_dedup.suffix_dedup(docs, keep=rest)
    return kept.withColumnRenamed("kept", "text").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of 4,096."""
    ship(spark)
    packed = packing.pack_documents(docs, packing.default_tokenizer(), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", keep_one_near_duplicate),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
