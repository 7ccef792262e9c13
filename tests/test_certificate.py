"""The optimality certificate tells a fit from a model that is no optimum."""

from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from moodstream.plans import certificate, model

FEATURES = model.with_label_names(model.replace(model.TFIDF, num_features=64), "text", "mood")
TEXTS = {"good": "nice day and warm sun", "bad": "cold grey rain and wind", "so": "some day like any other"}


def table(spark, moods):
    rows = []
    for i in range(90):
        mood = moods[i % len(moods)]
        words = TEXTS[mood].split() + TEXTS[moods[(i * 7) % len(moods)]].split()[: i % 4]
        rows.append((i, " ".join(words[i % 3 :] + [f"w{i % 11}"]), mood))
    rows += [(900, None, "good"), (901, "", "bad"), (902, "stray", None)]
    return spark.createDataFrame(rows, "id long, text string, mood string")


@pytest.mark.parametrize("moods", [("good", "bad", "so"), ("good", "bad")])
def test_a_fit_is_certified_and_its_loss_is_the_objective(spark, moods):
    rows = table(spark, moods)
    fitted = model.train(rows, FEATURES, model.logistic_regression())
    proof = certificate.certificate(rows, fitted, FEATURES).first()
    objective = fitted.stages[-2].summary.objectiveHistory[-1]
    assert abs(proof["loss"] - objective) < 1e-9 * objective + 1e-12
    assert max(proof["largest"], proof["offset"]) < 1e-4 * proof["loss"] and 0 <= proof["excess"] < 1e-6 * proof["loss"]


def test_a_fit_that_was_stopped_or_made_for_another_penalty_is_not(spark):
    rows = table(spark, ("good", "bad", "so"))
    stopped = certificate.certificate(rows, model.train(rows, FEATURES, model.logistic_regression(max_iter=1)), FEATURES).first()
    assert stopped["largest"] > 1e-3 * stopped["loss"]
    other = certificate.certificate(rows, model.train(rows, FEATURES, model.logistic_regression(reg=0.31)), FEATURES, reg=0.3).first()
    assert other["largest"] > 1e-4 * other["loss"]


def test_the_bound_holds_without_intercepts(spark):
    rows = table(spark, ("good", "bad", "so"))
    losses = {}
    for n in (1, 4, 300):
        classifier = model.logistic_regression(max_iter=n).setFitIntercept(False)
        losses[n] = certificate.certificate(rows, model.train(rows, FEATURES, classifier), FEATURES).first()
    for n in (1, 4):
        assert losses[n]["loss"] - losses[n]["excess"] <= losses[300]["loss"] <= losses[n]["loss"]


def test_gradient_against_sums_by_hand(spark):
    rows = table(spark, ("good", "bad", "so"))
    fitted = model.train(rows, FEATURES, model.logistic_regression(max_iter=3))
    got = {(r["class"], r["bucket"]): r for r in certificate.gradient(rows, fitted, FEATURES).collect()}
    used = rows.filter(F.col("text").isNotNull() & F.col("mood").isNotNull())
    made = model.prepare(used, fitted, FEATURES)
    scored = model.predict(made, fitted).join(made.select("id", vector_to_array("features").alias("x")), "id").select("mood", vector_to_array("probability").alias("p"), "x").collect()
    names, n = fitted.stages[-1].getLabels(), len(scored)
    beta = fitted.stages[-2].coefficientMatrix.toArray()
    for j in range(64):
        x = [r["x"][j] for r in scored]
        mean = sum(x) / n
        var = sum((v - mean) ** 2 for v in x) / (n - 1)
        for c, name in enumerate(names):
            observed = sum(v for v, r in zip(x, scored) if r["mood"] == name)
            expected = sum(v * r["p"][c] for v, r in zip(x, scored))
            if (name, j) not in got:
                assert not any(x)
                continue
            r = got[name, j]
            slope = (expected - observed) / n + 0.3 * var * beta[c][j]
            assert abs(r["observed"] - observed) < 1e-9 and abs(r["expected"] - expected) < 1e-9
            assert abs(r["gradient"] - (slope / var**0.5 if var > 1e-18 else 0)) < 1e-9


def test_empty_table(spark):
    rows = table(spark, ("good", "bad", "so"))
    fitted = model.train(rows, FEATURES, model.logistic_regression(max_iter=1))
    assert certificate.gradient(rows.limit(0), fitted, FEATURES).collect() == []
