"""Naive Bayes from counts: folds by subtraction and models that grow, against fits over the texts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from moodstream.plans import counted_bayes, model

FEATURES = model.with_label_names(model.replace(model.BAG_OF_WORDS, min_df=2.0), "text", "mood")
SCHEMA = "id long, text string, mood string, term string, n long, fold string"
WORDS = {"good": "nice fine warm lovely", "bad": "poor cold awful grim", "so": "plain even usual flat"}


def rows_of(n: int):
    out = []
    for i in range(n):
        mood = ("good", "bad", "good", "so", "bad", "good", "good")[i % 7]
        own = WORDS[mood].split()
        out.append((i, f"{own[i % 4]} {own[i * 3 % 4]} the day {i % 5} {WORDS['so'].split()[i % 3]}", mood, "t", i, "f"))
    return out


@pytest.fixture(scope="module")
def labelled(spark):
    odd = [(1000, None, "good", "t", 1, "f"), (1001, "", "bad", "t", 1, "f"), (1002, "fine", None, "t", 1, "f"), (1003, "unknownword", "so", "t", 1, "f")]
    repeated = [rows_of(7)[3]] * 3
    return spark.createDataFrame(rows_of(140) + odd + repeated, SCHEMA)


def test_counts(spark, labelled):
    rows = labelled.filter(F.col("text").isNotNull() & F.col("mood").isNotNull()).collect()
    got = {(r["class"], r["term"]): (r["n"], r["docs"]) for r in counted_bayes.counts(labelled, FEATURES).collect()}
    want = {}
    for r in rows:
        words = [w for w in r["text"].lower().split() if w not in FEATURES.stop_words]
        for term in [None, *set(words)]:
            n, docs = want.get((r["mood"], term), (0, 0))
            want[r["mood"], term] = (n + (1 if term is None else words.count(term)), docs + 1)
    assert got == want


@pytest.mark.parametrize("folds", [2, 5])
def test_cross_validation_equals_fits_per_fold(spark, labelled, folds):
    known = labelled.filter(F.col("mood").isNotNull())
    _, fitted = model.cross_validate(known, "id", FEATURES, model.naive_bayes(), {"smoothing": (0.25, 1.0, 3.0)}, folds=folds)
    want = {r["smoothing"]: round(r["f1"], 9) for r in fitted.collect()}
    got = counted_bayes.cross_validate(labelled, "id", FEATURES, (0.25, 1.0, 3.0), folds)
    assert {r["smoothing"]: round(r["f1"], 9) for r in got.collect()} == want


def test_texts_are_read_once(spark, labelled, tmp_path):
    """The file is gone once the lists of terms are written: nothing after that may read it."""
    path = str(tmp_path / "labelled")
    labelled.write.parquet(path)
    reads = spark.sparkContext.accumulator(0)
    df = spark.read.parquet(path)
    seen = []
    kept = counted_bayes.materialise

    def spy(frame, name):
        seen.append((name, path in str(frame._jdf.queryExecution().optimizedPlan().toString()) or path in frame._jdf.queryExecution().executedPlan().toString()))
        return kept(frame, name)

    counted_bayes.materialise = spy
    try:
        out = counted_bayes.cross_validate(df, "id", FEATURES, (1.0,), 3)
    finally:
        counted_bayes.materialise = kept
    assert [name for name, reads_it in seen if reads_it] == ["counted-rows"]
    assert path not in out._jdf.queryExecution().executedPlan().toString() and reads.value == 0
    assert out.count() == 1


def predicted(rows):
    return {r["id"]: (r["class"], round(r["p"], 9)) for r in rows.collect()}


def by_refit(labelled, docs):
    fitted = model.train(labelled.filter(F.col("mood").isNotNull()), FEATURES, model.naive_bayes())
    scored = model.score(docs, fitted, FEATURES)
    from pyspark.ml.functions import vector_to_array

    return predicted(scored.select("id", "class", F.array_max(vector_to_array("probability")).alias("p")))


def by_counts(docs, grown):
    return predicted(counted_bayes.predict(docs, grown, FEATURES).select("id", "class", F.col("confidence").alias("p")))


def test_growing_equals_a_refit_after_every_batch(spark, labelled, tmp_path):
    path, docs = str(tmp_path / "state"), labelled.drop("mood")
    batch = F.pmod(F.col("id"), F.lit(3))
    for k in range(3):
        counted_bayes.add_batch(path, f"day-{k}", labelled.filter(batch == k), FEATURES)
        grown = counted_bayes.stored_model(spark, path, FEATURES)
        assert by_counts(docs, grown) == by_refit(labelled.filter(batch <= k), docs)
    before = by_counts(docs, counted_bayes.stored_model(spark, path, FEATURES))
    counted_bayes.add_batch(path, "day-1", labelled.filter(batch == 1), FEATURES)
    assert by_counts(docs, counted_bayes.stored_model(spark, path, FEATURES)) == before
    first_two = counted_bayes.stored_model(spark, path, FEATURES, batches=["day-0", "day-1"])
    assert by_counts(docs, first_two) == by_refit(labelled.filter(batch <= 1), docs)
    with pytest.raises(ValueError, match="name"):
        counted_bayes.add_batch(path, "../x", labelled, FEATURES)


def test_a_large_vocabulary_goes_by_salted_terms(spark, labelled, monkeypatch):
    grown = counted_bayes.fit(counted_bayes.counts(labelled, FEATURES), FEATURES)
    want = by_counts(labelled, grown)
    monkeypatch.setattr(counted_bayes, "BROADCAST_BYTES", 0)
    assert by_counts(labelled, grown) == want


def test_predict_keeps_all_rows_and_columns(spark, labelled):
    grown = counted_bayes.fit(counted_bayes.counts(labelled, FEATURES), FEATURES)
    out = counted_bayes.predict(labelled, grown, FEATURES)
    assert out.columns == [*labelled.columns, "class", "confidence"] and out.count() == labelled.count()
    empty = out.filter(F.coalesce("text", F.lit("")) == "").select("class", F.round("confidence", 9)).distinct().collect()
    assert len(empty) == 1 and empty[0]["class"] == "good"  # the prior alone


def test_ties_go_to_the_more_frequent_class_then_by_name(spark):
    rows = [(i, "same words here", m, "t", 1, "f") for i, m in enumerate(["b", "a", "b", "a"])]
    tied = spark.createDataFrame(rows, SCHEMA)
    grown = counted_bayes.fit(counted_bayes.counts(tied, FEATURES), FEATURES)
    assert grown.classes == ("a", "b")
    assert {r["class"] for r in counted_bayes.predict(tied, grown, FEATURES).collect()} == {"a"}


def test_empty_tables(spark, labelled):
    empty = labelled.limit(0)
    with pytest.raises(ValueError, match="no row"):
        counted_bayes.cross_validate(empty, "id", FEATURES)
    grown = counted_bayes.fit(counted_bayes.counts(labelled, FEATURES), FEATURES)
    assert counted_bayes.predict(empty, grown, FEATURES).collect() == []
    with pytest.raises(ValueError, match="no term"):
        counted_bayes.fit(counted_bayes.counts(labelled.filter("id = 1001"), FEATURES), FEATURES)
