from __future__ import annotations

import json

import pytest

from moodstream.plans import model, workflows
from moodstream.sources import files


def _csv(path, rows):
    path.write_text("Sentence,Emotion\n" + "\n".join(f'"{s}",{e}' for s, e in rows), encoding="utf-8")
    return str(path)


def test_train_save_and_score_files(spark, tmp_path):
    rows = [("good, great fine", "positive"), ("bad sad awful", "negative"), ("lamp chair", "neutral")] * 30
    a, b = _csv(tmp_path / "a.csv", rows), _csv(tmp_path / "b.csv", rows + [("", "positive"), ("x", "")])
    saved = str(tmp_path / "model")
    run = workflows.train_from_csv(spark, [a, b], saved, model.BAG_OF_WORDS, model.naive_bayes(), fit_features_on_all=True)
    assert run.f1 == pytest.approx(1.0) and run.accuracy == pytest.approx(1.0)
    assert sorted(map(tuple, run.distribution.collect())) == [("negative", 60), ("neutral", 60), ("positive", 60)]
    assert run.test_predictions.count() > 0
    assert run.misfits.count() == 2
    new = tmp_path / "new.csv"
    new.write_text('Sentence\n"sad, awful"\ngreat\n')
    got = workflows.score_csv(spark, str(new), model.load(saved), model.BAG_OF_WORDS)
    assert {r["Sentence"]: r["class"] for r in got.collect()} == {"sad, awful": "negative", "great": "positive"}


def test_merge(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.csv").write_text("User ID,Comment\nu,a\n")
    (source / "2.csv").write_text("Comment,Label\nb,1\n")
    workflows.merge_csv(spark, str(source), str(tmp_path / "out"))
    back = files.merged_csv(spark, str(tmp_path / "out"))
    assert sorted(back.columns) == ["Comment", "Label", "User ID"] and back.count() == 2


def test_archive_dashboard(spark, tmp_path):
    def item(i, p):
        return json.dumps({"UserID": f"u{i % 3}", "Sentence": f"s{i}", "prediction": p})

    for n in range(12):
        batch = [item(20 * n + i, float(i % 3)) for i in range(3 + n)]
        (tmp_path / f"file_{n:02d}.json").write_text(json.dumps(batch, indent=4))
    tables = workflows.archive_dashboard(spark, str(tmp_path))
    last = tables["snapshots"].collect()
    assert len(last) == 10 and last[0]["file"].endswith("file_11.json")
    total = sum(3 + n for n in range(12))
    assert last[0]["positive"] + last[0]["negative"] + last[0]["neutral"] == total
    assert sum(r["n"] for r in tables["share"].collect()) == total
    assert tables["totals"].first()["comments_total"] == total
    assert tables["totals"].first()["users_total"] == 3
    latest = tables["latest"].collect()
    assert len(latest) == 39
    assert max(r["file"] for r in latest).endswith("file_11.json")
