from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodstream.functions.text import tokens
from moodstream.operators import heavy, terms


def table_of(counts):
    return pa.table({"term": pa.array([t for t, _ in counts], pa.string()), "n": pa.array([n for _, n in counts], pa.int64()), "docs": pa.array([1] * len(counts), pa.int64())})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("abcdefghij"), st.integers(1, 9)), max_size=8), max_size=8), st.integers(1, 6))
def test_a_summary_never_lacks_more_than_its_loss(batches, capacity):
    held, loss, true = table_of([]), 0, Counter()
    for batch in batches:
        for term, n in batch:
            true[term] += n
        held, off = heavy._cut(heavy._added_up([held, table_of(batch)]), capacity)
        loss += off
        assert held.num_rows <= capacity
    kept = dict(zip(held["term"].to_pylist(), held["n"].to_pylist()))
    for term, n in true.items():
        assert n - loss <= kept.get(term, 0) <= n


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(600):
        words = [f"top{j}" for j in range(12) if (i * 7 + j) % (j + 2) == 0] * 2 + [f"rare{i}_{j}" for j in range(6)] + ["copied"] * (50 if i == 3 else 0)
        rows.append((i, " ".join(words), "t", 1, 2))
    rows += [(1000, None, "t", 1, 2), (1001, "", "t", 1, 2), (5, "top0 top1", "t", 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, term string, tf long, n long").repartition(5)


def words():
    return tokens(F.col("text"))


def exact(docs, least, size):
    return [tuple(r) for r in terms.vocabulary(terms.term_stats(terms.term_frequencies(docs, words())), least, size).collect()]


@pytest.mark.parametrize("capacity,size,certain", [(100_000, 30, True), (400, 5, True), (8, 11, False), (400, 5000, False)])
def test_equal_to_counting_all_terms(docs, capacity, size, certain):
    found = heavy.candidates(heavy.summaries(docs, words(), capacity), size, 5)
    assert found.certain is certain and (found.loss == 0) == (capacity == 100_000)
    got = [tuple(r) for r in heavy.heavy_vocabulary(docs, words(), 5, size, capacity).collect()]
    assert got == exact(docs, 5, size)
    if certain and found.loss:
        assert found.terms.count() < 100  # of some 3,600 terms


def test_a_frequent_term_of_few_documents_takes_no_place(docs):
    got = heavy.heavy_vocabulary(docs, words(), 5, 8, 400).collect()
    assert [tuple(r) for r in got] == exact(docs, 5, 8) and "copied" not in {r["term"] for r in got}


def test_empty_table(docs):
    assert heavy.heavy_vocabulary(docs.limit(0), words()).collect() == []
    assert heavy.heavy_vocabulary(docs.filter("text is null"), words()).collect() == []


def test_rare_terms_are_not_shuffled(docs):
    plan = heavy.heavy_vocabulary(docs, words(), 5, 5, 400)._jdf.queryExecution().executedPlan().toString()
    join, shuffle = plan.index("LeftSemi"), plan.rindex("Exchange hashpartitioning(term")
    assert shuffle < join  # the plan is printed from the result down: the join comes before the shuffle
