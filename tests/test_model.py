from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from moodstream.operators import ranking
from moodstream.plans import metrics, model

GOOD, BAD, PLAIN = "good fine great", "bad awful sad", "table chair lamp"


def _rows(n=240, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        label, words = rng.choice([("positive", GOOD), ("positive", GOOD), ("negative", BAD), ("neutral", PLAIN)])
        noise = "the http one two three".split()
        out.append((i, " ".join(rng.choices(words.split(), k=4) + rng.choices(noise, k=3)), label))
    return out


@pytest.fixture(scope="module")
def labelled(spark):
    rows = _rows()
    return spark.createDataFrame(rows, "id long, Sentence string, Emotion string").cache(), rows


@pytest.fixture(scope="module")
def bayes(labelled):
    return model.train(labelled[0], model.BAG_OF_WORDS, model.naive_bayes())


def test_naive_bayes_against_brute_force(labelled, bayes):
    df, rows = labelled
    tokens = {i: [w for w in re.split(r"\W", s.lower()) if w and w not in model.STOP_WORDS] for i, s, _ in rows}
    freq = Counter(w for t in tokens.values() for w in set(t))
    vocab = {w for w, n in freq.items() if n >= 5}
    per_class, docs = {}, Counter(c for _, _, c in rows)
    for i, _, c in rows:
        per_class.setdefault(c, Counter()).update(w for w in tokens[i] if w in vocab)
    for row in model.score(df, bayes, model.BAG_OF_WORDS).collect():
        logs = {}
        for c, counts in per_class.items():
            total = sum(counts.values()) + len(vocab)
            logs[c] = math.log((docs[c] + 1) / (len(rows) + len(docs)))
            logs[c] += sum(math.log((counts[w] + 1) / total) for w in tokens[row["id"]] if w in vocab)
        top = max(logs.values())
        assert row["class"] == max(logs, key=logs.get)
        assert max(row["probability"]) == pytest.approx(1 / sum(math.exp(v - top) for v in logs.values()))


def test_scoring_needs_no_label_and_keeps_null_text(spark, bayes):
    new = spark.createDataFrame([("u", "good great"), ("v", "awful"), ("w", None), ("x", "")], "UserID string, Sentence string")
    got = {r["UserID"]: r["class"] for r in model.score(new, bayes, model.BAG_OF_WORDS).collect()}
    assert (got["u"], got["v"]) == ("positive", "negative")
    assert got["w"] == got["x"] == "positive"  # no words: the most frequent class
    assert model.score(new, bayes, model.BAG_OF_WORDS).filter("UserID = 'w'").first()["Sentence"] is None


def test_scoring_other_labels_in_input_does_not_fail(spark, bayes):
    new = spark.createDataFrame([("sad bad", "never seen")], "Sentence string, Emotion string")
    assert model.score(new, bayes, model.BAG_OF_WORDS).first()["class"] == "negative"


def test_saved_model_predicts_the_same(labelled, bayes, tmp_path):
    df, _ = labelled
    path = str(tmp_path / "model")
    model.save(bayes, path)
    model.save(bayes, path)  # replaces
    key = lambda m: sorted((r["id"], r["class"], tuple(r["probability"])) for r in model.score(df, m, model.BAG_OF_WORDS).collect())
    assert key(model.load(path)) == key(bayes)


def test_logistic_regression(labelled):
    df, _ = labelled
    train, test = model.hash_split(df, "id")
    fitted = model.train(train, model.TFIDF, model.logistic_regression())
    scored = model.label_position(model.score(test, fitted), fitted, "Emotion")
    assert metrics.evaluate(scored) > 0.9
    assert metrics.evaluate(scored, "accuracy") > 0.9
    # The most frequent class has index 0.
    assert scored.filter("Emotion = 'positive'").select("label").distinct().first()[0] == 0.0
    all_rows = model.train(train, model.TFIDF, model.logistic_regression(), fit_features_on=df)
    assert metrics.evaluate(model.label_position(model.score(test, all_rows), all_rows, "Emotion")) > 0.9


def test_metrics_equal_spark(spark):
    rng = random.Random(4)
    pairs = [(rng.choice([0.0, 0.0, 1.0, 2.0]), rng.choice([0.0, 1.0, 3.0])) for _ in range(400)]
    df = spark.createDataFrame(pairs, "label double, prediction double")
    table = metrics.confusion(df.select(F.col("label").alias("actual"), F.col("prediction").alias("predicted")))
    assert metrics.weighted_f1(table).first()[0] == pytest.approx(metrics.evaluate(df))
    assert metrics.accuracy(table).first()[0] == pytest.approx(metrics.evaluate(df, "accuracy"))


def test_splits(labelled):
    df, rows = labelled
    train, test = model.hash_split(df, "id")
    ids = lambda d: {r["id"] for r in d.select("id").collect()}
    assert ids(train) | ids(test) == {r[0] for r in rows} and not ids(train) & ids(test)
    assert 0.65 < len(ids(train)) / len(rows) < 0.92
    assert ids(model.hash_split(df.repartition(7), "id")[0]) == ids(train)
    a, b = model.random_split(df)
    assert a.count() + b.count() == len(rows)


def test_retrain_learns_new_rows(spark, labelled):
    stored = labelled[0].select("Sentence", "Emotion")
    arrived = spark.createDataFrame([("zebra giraffe zebra", "negative")] * 30, "Sentence string, Emotion string")
    fitted = model.retrain(stored, arrived, model.BAG_OF_WORDS, model.naive_bayes())
    new = spark.createDataFrame([("zebra",)], "Sentence string")
    assert model.score(new, fitted, model.BAG_OF_WORDS).first()["class"] == "negative"


def test_top_k(labelled, bayes):
    df, _ = labelled
    scored = model.score(df, bayes, model.BAG_OF_WORDS).cache()
    best = sorted((-round(max(r["probability"]), 6), r["id"]) for r in scored.collect())[:7]
    assert [(-r["confidence"], r["id"]) for r in ranking.top_by_confidence(scored, 7, id_col="id").collect()] == best
    want = sorted(([-round(p, 6) for p in r["probability"]], r["id"]) for r in scored.collect() if r["prediction"] != 0)[:5]
    assert [r["id"] for r in ranking.top_by_first_class(scored, 5, id_col="id").collect()] == [i for _, i in want]


def test_cross_validation_small(labelled):
    grid = {"regParam": (0.1, 0.5), "elasticNetParam": (0.0,)}
    found = []
    for parts in (2, 4, 7):
        rows = labelled[0].repartition(parts)
        best, scores = model.cross_validate(rows, "id", model.BAG_OF_WORDS, model.logistic_regression(max_iter=3), grid, folds=2)
        found.append([(r["regParam"], r["elasticNetParam"], round(r["f1"], 9)) for r in scores.collect()])
    assert [r[:2] for r in found[0]] == [(0.1, 0.0), (0.5, 0.0)] and all(0 < r[2] <= 1 for r in found[0])
    assert found[0] == found[1] == found[2]  # folds go by a hash, so partitions do not matter
    assert model.score(labelled[0], best, model.BAG_OF_WORDS).count() == len(labelled[1])


def test_fits_pass_over_few_even_tasks(labelled, monkeypatch):
    """Each task of a pass costs a whole gradient, so the fits do not get the many splits of the texts."""
    df, rows = labelled
    sizes = []
    fit = model.CrossValidator.fit

    def seen(search, prepared):
        sizes.append(prepared.rdd.glom().map(len).collect())
        return fit(search, prepared)

    monkeypatch.setattr(model.CrossValidator, "fit", seen)
    found = []
    for fewest, most in ((2_000_000, 16_000_000), (1, 16_000_000), (1, 100)):
        monkeypatch.setattr(model, "FEWEST_WORDS", fewest)
        monkeypatch.setattr(model, "MOST_WORDS", most)
        grid = {"smoothing": (0.5, 2.0)}
        _, scores = model.cross_validate(df.repartition(40), "id", model.BAG_OF_WORDS, model.naive_bayes(), grid, folds=2)
        found.append([(r["smoothing"], round(r["f1"], 9)) for r in scores.collect()])
    words = sum(w not in model.STOP_WORDS for _, s, _ in rows for w in s.split())
    assert [len(s) for s in sizes] == [1, 8, -(-words // 100)]
    assert all(sum(s) == len(rows) and max(s) - min(s) <= len(s) for s in sizes)
    assert found[0] == found[1] == found[2]


def test_tasks_of_a_pass():
    assert [model.pass_tasks(n, 12) for n in (0, 1, 2_000_001, 10**8, 192_000_001, 10**9)] == [1, 1, 2, 12, 13, 63]


def test_vocabulary_cut_among_equal_counts(spark):
    rows = [(" ".join(f"w{i:02d}" for i in range(20)), "positive"), (" ".join(f"w{i:02d}" for i in range(20)), "negative")]
    df = spark.createDataFrame(rows, "Sentence string, Emotion string")
    small = model.replace(model.BAG_OF_WORDS, vocab_size=7, min_df=1.0)
    for parts in (1, 3):
        fitted = model.train(df.repartition(parts), small, model.naive_bayes())
        assert fitted.stages[2].vocabulary == [f"w{i:02d}" for i in range(7)]


def test_two_step_scoring_is_the_same(labelled, bayes):
    df, _ = labelled
    columns = ["id", "prediction", "class"]
    both = model.predict(model.prepare(df, bayes, model.BAG_OF_WORDS), bayes)
    whole = model.score(df, bayes, model.BAG_OF_WORDS)
    assert sorted(map(tuple, both.select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))


def test_labels_by_frequency_then_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "Emotion string")
    fitted = model.fit_labels(df, model.TFIDF)
    assert list(fitted.labels) == ["c", "a", "b"]
    assert fitted.transform(df).count() == 4  # no label, no row
    with pytest.raises(ValueError):
        model.fit_labels(df, model.TFIDF, max_classes=2)
    strict = model.fit_labels(df.filter("Emotion <> 'c'"), model.TFIDF, invalid="error")
    with pytest.raises(Exception):
        strict.transform(df).collect()
