from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from moodstream.llm.quality import FactorisationMachine, features, op10, score, train

FOLDER = "/root/testdata/sf0.01"


def test_linear_time_margin_is_the_pairwise_sum():
    rng = np.random.default_rng(0)
    model = FactorisationMachine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    index, value = np.array([3, 7, 20, 41]), np.array([0.5, -1.0, 2.0, 0.1])
    pairs = sum(model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    want = 0.3 + model.weight[index] @ value + pairs
    assert np.isclose(model.margins(index, value, np.array([0]))[0], want)


def test_held_out_accuracy(llm):
    rows = op10(llm, FOLDER).join(llm.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_held_out_labels_teach_nothing(llm):
    docs, labels = (llm.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    other = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = train(docs, labels, 200, 2), train(docs, other, 200, 2)
    assert first.bias == second.bias and np.array_equal(first.weight, second.weight)


def test_odd_rows(llm, odd_docs):
    empty = llm.createDataFrame([], "doc_id long, quality int")
    model = train(odd_docs, empty)
    rows = score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    labels = llm.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 1), (4, 1)], "doc_id long, quality int")
    assert score(odd_docs, train(odd_docs, labels)).count() == odd_docs.count()
    assert score(odd_docs.limit(0), model).count() == 0
    assert len(features(None, None)[0]) == len(features("", -5)[0])
