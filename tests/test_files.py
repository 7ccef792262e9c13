from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from moodstream import schemas
from moodstream.sinks import files as sinks
from moodstream.sources import files, stream


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_labelled_csv_with_edges(spark, tmp_path):
    path = _write(tmp_path / "a.csv", (
        "Sentence,Emotion\n"
        '"hôm nay, đẹp",Other\n'
        "hôm nay, là thứ,Other\n"
        '"hai\ndòng",Sadness\n'
        '"nói ""hay"" quá",Enjoyment\n'
        "một mình\n"
    ), "utf-8-sig")
    df = files.csv_table(spark, path, multi_line=True).cache()
    assert sorted(map(tuple, files.fitting_rows(df).collect())) == [
        ("hai\ndòng", "Sadness"), ("hôm nay, đẹp", "Other"), ('nói "hay" quá', "Enjoyment"),
    ]
    assert sorted(r[schemas.CORRUPT] for r in files.bad_rows(df).collect()) == ["hôm nay, là thứ,Other", "một mình"]


def test_other_names_and_scoring_csv(spark, tmp_path):
    path = _write(tmp_path / "b.csv", "x,y\nhello,1\n")
    assert files.fitting_rows(files.csv_table(spark, path, schemas.LABELLED_ALT)).columns == ["clean_text", "category"]
    one = _write(tmp_path / "c.csv", 'Sentence\n"a, b"\nc\n')
    assert sorted(r["Sentence"] for r in files.scoring_csv(spark, one).collect()) == ["a, b", "c"]
    every = _write(tmp_path / "d.csv", 'Sentence\nhello there\ntoday, is fine\n""\nlast\n')
    assert sorted(r["Sentence"] for r in files.scoring_csv(spark, every).collect()) == ["", "hello there", "last", "today, is fine"]


def test_csv_round_trip_keeps_text(spark, tmp_path):
    rows = [("u", " lead and trail "), ("v", 'q"uote, comma'), ("w", "line\nbreak"), ("x", "đẹp \\ back"), ("y", ""), ("z", None), ("a", "\r\n")]
    df = spark.createDataFrame(rows, schemas.COMMENT)
    path = str(tmp_path / "out")
    sinks.write_csv(df, path)
    got = files.fitting_rows(files.csv_table(spark, path, schemas.COMMENT, True, empty_is_null=False))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    one_line = str(tmp_path / "escaped")
    sinks.write_csv(df.unionAll(spark.createDataFrame([("b", "\\n \\\n\\")], schemas.COMMENT)), one_line, escape_breaks=True)
    got = files.fitting_rows(files.csv_table(spark, one_line, schemas.COMMENT, empty_is_null=False, escaped_breaks=True))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([*rows, ("b", "\\n \\\n\\")], key=str)
    plain = files.fitting_rows(files.csv_table(spark, path, schemas.COMMENT, True))
    assert plain.filter("Sentence IS NULL").count() == 2


def test_escaped_breaks_need_no_letter_of_their_own(spark, tmp_path):
    texts = ["a\x00b", "\x00", "\\\x00n", "\\\\n", "\n\\", "\\r\r\\\r", "\x00fffd\x00", "\\" * 7 + "n"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], schemas.COMMENT)
    path = str(tmp_path / "nul")
    sinks.write_csv(df, path, escape_breaks=True)
    got = files.fitting_rows(files.csv_table(spark, path, schemas.COMMENT, empty_is_null=False, escaped_breaks=True))
    assert [r["Sentence"] for r in got.orderBy("UserID").collect()] == texts


def test_scoring_csv_with_escaped_breaks(spark, tmp_path):
    texts = ["two\nlines, and \\ more", "", 'q"q', "plain"]
    path = str(tmp_path / "score")
    sinks.write_csv(spark.createDataFrame([(t,) for t in texts], "Sentence string"), path, escape_breaks=True)
    assert sorted(r["Sentence"] for r in files.scoring_csv(spark, path, escaped_breaks=True).collect()) == sorted(texts)


def test_a_header_that_never_ends_is_an_error(spark, tmp_path):
    _write(tmp_path / "1.csv", '"a\n' + "b\n" * 30)
    with pytest.raises(Exception, match="header is not closed"):
        files.csv_headers(spark, str(tmp_path)).collect()


def test_arrays_of_many_batches_share_a_file(spark, tmp_path):
    rows = [(i, i // 3, "u", f"s{i}", float(i % 3)) for i in range(100)] + [(100, 900, None, 'q"\\', None)]
    df = spark.createDataFrame(rows, "at long, batch long, UserID string, Sentence string, prediction double")
    path = str(tmp_path / "arrays")
    item = F.to_json(F.struct("UserID", "Sentence", "prediction"))
    sinks.write_arrays(df.coalesce(1), path, "batch", "at", item)
    got = files.array_archive(spark, path).orderBy("batch", "pos").collect()
    assert [(r["batch"], r["pos"], r["UserID"], r["Sentence"], r["prediction"]) for r in got] == [(b, i % 3 if i < 100 else 0, u, s, p) for i, b, u, s, p in rows]
    assert len(list((tmp_path / "arrays").glob("*.json"))) <= 8
    assert files.array_archive(spark, path).filter("batch = 900").count() == 1


def test_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([("u", "a")], schemas.RAW_COMMENT).coalesce(1)
    path = tmp_path / "bom"
    sinks.write_csv(df, str(path), bom=True)
    data = [p.read_bytes() for p in path.glob("*.csv")]
    assert [d[:3] for d in data] == [b"\xef\xbb\xbf"]
    got = files.merged_csv(spark, str(path))
    assert got.columns == ["User ID", "Comment"] and [tuple(r) for r in got.collect()] == [("u", "a")]


def test_merged_csv(spark, tmp_path):
    _write(tmp_path / "1.csv", 'User ID,Comment\nu,"a\nb"\n', "utf-8-sig")
    _write(tmp_path / "2.csv", "User ID,Comment\nv,c\n")
    _write(tmp_path / "3.csv", "Comment,Label\nd,1\n")
    _write(tmp_path / "skip.txt", "Comment\nno\n")
    want = [("u", "a\nb", None), ("v", "c", None), (None, "d", "1")]
    got = files.merged_csv(spark, str(tmp_path), multi_line=True).select("User ID", "Comment", "Label")
    assert sorted(map(tuple, got.collect()), key=str) == want
    layouts = {"[12].csv": ["User ID", "Comment"], "3.csv": ["Comment", "Label"]}
    got = files.merged_csv(spark, str(tmp_path), multi_line=True, layouts=layouts).select("User ID", "Comment", "Label")
    assert sorted(map(tuple, got.collect()), key=str) == want
    with pytest.raises(Exception):
        files.merged_csv(spark, str(tmp_path), layouts={"3.csv": ["Label", "Comment"]}).collect()


def test_header_with_a_break_in_quotes(spark, tmp_path):
    _write(tmp_path / "1.csv", '"a ""x""\nb",c\n1,2\n')
    assert [r["header"] for r in files.csv_headers(spark, str(tmp_path)).collect()] == ['"a ""x""\nb",c']
    assert files.merged_csv(spark, str(tmp_path), multi_line=True).columns == ['a "x"\nb', "c"]


def test_merged_csv_of_nothing_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.merged_csv(spark, str(tmp_path))


def test_scored_archive(spark, tmp_path):
    item = '{"UserID":"userID","Sentence":"ô","prediction":2.0,"Sentence":"ô","prediction":2.0}'
    (tmp_path / "file_1.json").write_text(json.dumps([item, item], indent=4))
    (tmp_path / "file_2.json").write_text(json.dumps([{"UserID": "u", "Sentence": "x"}]))
    got = files.scored_archive(spark, str(tmp_path))
    rows = sorted((r["file"][-6:], r["pos"], r["UserID"], r["Sentence"], r["prediction"]) for r in got.collect())
    assert rows[:2] == [("1.json", 0, "userID", "ô", 2.0), ("1.json", 1, "userID", "ô", 2.0)]
    assert rows[2][2:] == ("u", "x", None)


def test_word_list(spark, tmp_path):
    path = _write(tmp_path / "stop.txt", "a lô\na ha\nai\n ai \n\nanh ấy")
    entries = files.word_list(spark, path)
    assert entries == ["a ha", "a lô", "ai", "anh ấy"]
    assert files.single_words(entries) == ["ai"]
    assert files.phrases(entries) == ["a ha", "a lô", "anh ấy"]
    assert files.word_list(spark, path, only_line=2) == ["a ha"]
    with pytest.raises(ValueError):
        files.word_list(spark, path, limit=2)


def test_archive_batches_do_not_replace_each_other(spark, tmp_path):
    df = spark.createDataFrame([(0, "u", "a", 0.0), (1, "v", "b", None)], "batch long, UserID string, Sentence string, prediction double")
    path = str(tmp_path / "arch")
    sinks.write_archive(df.filter("batch = 0"), path, "batch")
    sinks.write_archive(df.filter("batch = 1"), path, "batch")
    lines = spark.read.text(path)
    got = lines.select("batch", F.from_json("value", schemas.SCORED).alias("r")).select("batch", "r.*")
    assert sorted(map(tuple, got.drop("class").collect())) == [(0, "u", "a", 0.0), (1, "v", "b", None)]


def test_negative_users_replace_the_table(spark, tmp_path):
    df = spark.createDataFrame([("u", "a", "negative"), ("u", "b", "negative"), ("v", "c", "neutral")], "UserID string, Sentence string, class string")
    path = str(tmp_path / "neg")
    sinks.write_negative_users(df, path)
    sinks.write_negative_users(df, path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("u",), ("u",)]
    sinks.write_negative_users(df, path, comment="Sentence")
    assert spark.read.parquet(path).columns == ["UserID", "Sentence"]


def test_scored_table_skips_other_classes(spark, tmp_path):
    df = spark.createDataFrame([("u", "negative"), ("v", "neutral")], "UserID string, class string")
    path = str(tmp_path / "scored")
    sinks.write_scored(df, path)
    one = spark.read.parquet(path).filter("class = 'negative'")
    assert [r["UserID"] for r in one.collect()] == ["u"]
    assert "PartitionFilters: [isnotnull(class" in one._jdf.queryExecution().executedPlan().toString()


def test_json_and_preview(spark, tmp_path, capsys):
    df = spark.createDataFrame([("u", "a")], schemas.COMMENT)
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.schema(schemas.COMMENT).json(str(tmp_path / "j")).count() == 1
    sinks.preview(df)
    assert "Sentence" in capsys.readouterr().out


def test_kafka_options():
    options = stream.kafka_options("t", "h:1", maxOffsetsPerTrigger="5", kafka__group__id="g")
    assert options["subscribe"] == "t" and options["kafka.bootstrap.servers"] == "h:1"
    assert options["maxOffsetsPerTrigger"] == "5" and options["kafka.group.id"] == "g"
