from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import CountVectorizer, HashingTF, IDF, RegexTokenizer
from pyspark.sql import functions as F

from moodstream.functions import text
from moodstream.operators import terms
from moodstream.operators.joins import salted_lookup


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(["the"] * rng.randrange(0, 5) + rng.choices(words, k=rng.randrange(0, 30)))) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def _pairs(df):
    return terms.term_frequencies(df, text.tokens(F.col("text")))


def test_tf_idf_against_brute_force(docs):
    df, rows = docs
    counts = {i: Counter(t.split()) for i, t in rows}
    freq = Counter(w for c in counts.values() for w in c)
    want = {
        (i, w): tf * (math.log((len(rows) + 1) / (freq[w] + 1)) if freq[w] >= 2 else 0.0)
        for i, c in counts.items() for w, tf in c.items()
    }
    pairs = _pairs(df)
    weights = terms.inverse_document_frequency(terms.term_stats(pairs), df)
    # Small limits make frequent terms hot, so the salted path is used.
    got = terms.tf_idf(pairs, weights, rows_per_salt=20).collect()
    assert {(r["doc_id"], r["term"]): pytest.approx(r["tfidf"]) for r in got} == want
    assert len(got) == len(want)


def test_idf_equals_spark_ml(docs):
    df, _ = docs
    words = RegexTokenizer(inputCol="text", outputCol="words", pattern=text.WHITESPACE).transform(df)
    vectors = CountVectorizer(inputCol="words", outputCol="tf").fit(words)
    fitted = IDF(inputCol="tf", outputCol="x", minDocFreq=2).fit(vectors.transform(words))
    want = dict(zip(vectors.vocabulary, fitted.idf))
    weights = terms.inverse_document_frequency(terms.term_stats(_pairs(df)), df)
    assert {r["term"]: pytest.approx(r["idf"]) for r in weights.collect()} == want


def test_vocabulary_ties_are_settled_by_term(spark):
    stats = spark.createDataFrame([("b", 5, 5), ("a", 5, 5), ("c", 9, 4), ("d", 9, 5)], "term string, term_count long, doc_freq long")
    assert [r["term"] for r in terms.vocabulary(stats, 5, 2).collect()] == ["d", "a"]


def test_only_the_caller_deals_rows_anew(spark, docs):
    assert terms.dealt(docs[0], "doc_id") is docs[0]
    assert terms.dealt(docs[0], "doc_id", 5).rdd.getNumPartitions() == 5


@pytest.mark.parametrize("rows_per_salt", [1, 3, 5_000_000])
def test_salted_lookup(spark, rows_per_salt):
    facts = [(i, "hot" if i % 3 else f"k{i}") for i in range(90)]
    stats = [(k, n) for k, n in Counter(k for _, k in facts).items()]
    df, lookup = spark.createDataFrame(facts, "i long, k string"), spark.createDataFrame(stats, "k string, n long")
    got = salted_lookup(df, lookup, "k", "n", "i", rows_per_salt=rows_per_salt)
    sizes = dict(stats)
    assert sorted((r["i"], r["k"], r["n"]) for r in got.collect()) == [(i, k, sizes[k]) for i, k in facts]


def test_hashed_counts_keep_all_tokens(docs):
    df, rows = docs
    words = df.withColumn("words", text.tokens(F.col("text")))
    hashed = HashingTF(inputCol="words", outputCol="v", numFeatures=8000).transform(words)
    total = hashed.select(F.explode(F.unwrap_udt("v").getField("values")).alias("n")).agg(F.sum("n")).first()[0]
    assert total == sum(len(t.split()) for _, t in rows)


def test_counts_by_id_with_repeated_and_null_ids(spark, capsys):
    rows = [(1, "b a b"), (2, "a"), (1, "b c"), (None, "a"), (None, "a d"), (3, ""), (4, None), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter()
    for i, t in rows:
        want.update((i, w) for w in (t or "").split())
    found = terms.counts_by_id(df, text.tokens(F.col("text")))
    got = [((r["doc_id"], r["term"]), r["tf"]) for r in found.collect()]
    assert len(got) == len(want) and dict(got) == want
    # Rows with an id of their own are not dealt by (id, term), whatever the number of terms.
    found.explain()
    plan = capsys.readouterr().out
    of_once = [line for line in plan.splitlines() if line.startswith("   :")]
    assert "Union" in plan and of_once and not any("hashpartitioning" in line for line in of_once)
