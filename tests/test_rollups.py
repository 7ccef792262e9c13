from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from moodstream.functions import classes, times
from moodstream.operators import basics, joins, ranking, rollups

CODES = {"positive": 1.0, "negative": 2.0, "neutral": 0.0}


def _scored(spark, rows):
    """(id, user, class, hour) rows."""
    return spark.createDataFrame(rows, "id long, UserID string, class string, hour long")


def _skewed(n=3000):
    # One user and one hour hold more than a third of all rows; some rows have no class.
    rng = random.Random(11)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4
        rows.append((
            i, "hot" if hot else f"u{rng.randrange(200)}",
            rng.choice(["positive", "negative", "neutral", "neutral", None]),
            7 if hot else rng.randrange(100),
        ))
    return rows


def test_distribution_counts_null_and_orders_ties(spark):
    rows = _scored(spark, [(1, "a", "x", 0), (2, "a", None, 0), (3, "b", "y", 0), (4, "b", "y", 0), (5, "c", None, 0), (6, "c", "z", 0)])
    got = [tuple(r) for r in rollups.class_distribution(rows).collect()]
    assert got == [(None, 2), ("y", 2), ("x", 1), ("z", 1)]


def test_running_totals_against_brute_force(spark):
    rows = _skewed()
    counts = rollups.class_counts_by_batch(_scored(spark, rows), "hour")
    got = rollups.running_totals(counts, "hour", F.floor(F.col("hour") / 10))
    per_hour = defaultdict(Counter)
    for _, _, c, h in rows:
        per_hour[h][c] += 1
    want, total = {}, Counter()
    for h in sorted(per_hour):
        total.update(per_hour[h])
        want[h] = (total["positive"], total["negative"], total["neutral"])
    assert {r["hour"]: (r["positive"], r["negative"], r["neutral"]) for r in got.collect()} == want


def test_running_totals_read_the_input_once(spark):
    counts = rollups.class_counts_by_batch(_scored(spark, _skewed(200)), "hour")
    got = rollups.running_totals(counts, "hour", F.floor(F.col("hour") / 10))
    got.collect()
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


def test_totals_and_users(spark):
    rows = _skewed()
    df = _scored(spark, rows)
    known = [r for r in rows if r[2]]
    totals = rollups.grand_totals(df).first().asDict()
    assert totals["total"] == len(known)
    users = rollups.user_totals(df).first().asDict()
    assert users["comments_total"] == len(known)
    assert users["users_total"] == len({r[1] for r in known})
    for c in classes.CLASSES:
        assert totals[c] == users[f"comments_{c}"] == sum(r[2] == c for r in rows)
        assert users[f"users_{c}"] == len({r[1] for r in rows if r[2] == c})


def test_user_totals_of_nothing_and_null_user(spark):
    empty = rollups.user_totals(_scored(spark, [])).first()
    assert set(empty.asDict().values()) == {0}
    one = rollups.user_totals(_scored(spark, [(1, None, "positive", 0)])).first()
    assert (one["comments_positive"], one["users_positive"]) == (1, 0)


def test_share(spark):
    rows = _scored(spark, [(i, "u", c, 0) for i, c in enumerate(["positive"] * 2 + ["negative"] + [None])])
    got = {r["class"]: (r["n"], r["pct"]) for r in rollups.class_share(rows).collect()}
    assert got == {"positive": (2, 66.7), "negative": (1, 33.3)}


def test_negative_users(spark):
    rows = _skewed(500)
    df = _scored(spark, rows)
    want = Counter(r[1] for r in rows if r[2] == "negative")
    assert Counter(r["UserID"] for r in rollups.negative_users(df).collect()) == want
    assert {r["UserID"]: r["n"] for r in rollups.negative_user_counts(df).collect()} == dict(want)


def test_latest_per_class(spark):
    rows = _skewed()
    got = ranking.latest_per_class(_scored(spark, rows), ["hour", "id"], 13).collect()
    for c in classes.CLASSES:
        want = sorted([(r[3], r[0]) for r in rows if r[2] == c], reverse=True)[:13]
        assert sorted([(r["hour"], r["id"]) for r in got if r["class"] == c], reverse=True) == want
    plan = ranking.latest_per_class(_scored(spark, rows), ["hour", "id"], 13)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle


def test_cap_children(spark):
    rows = [(p, i) for p in range(4) for i in range(2 + 40 * (p == 0))]
    df = spark.createDataFrame(rows, "parent long, turn long")
    got = Counter(r["parent"] for r in ranking.cap_children(df, "parent", "turn", 5).collect())
    assert got == {0: 5, 1: 2, 2: 2, 3: 2}


def test_last_rows(spark):
    df = spark.range(100)
    assert [r["id"] for r in ranking.last_rows(df, "id", 10).collect()] == list(range(99, 89, -1))


def test_classes_and_routing(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 1.0, 2.0, 3.0, -1.0, None)], "prediction double")
    got = {r["prediction"]: r["class"] for r in basics.with_class(df).collect()}
    assert got == {0.0: "neutral", 1.0: "positive", 2.0: "negative", 3.0: None, -1.0: None, None: None}
    routed = basics.route(basics.with_class(df))
    assert {c: [r["prediction"] for r in d.collect()] for c, d in routed.items()} == {c: [CODES[c]] for c in CODES}
    assert basics.other_than(df, "prediction", 0.0).count() == 4


def test_recode(values):
    coded = classes.recode(F.col("v"), {"C": "-1", "P": "1"})
    assert values(coded, ["C", "P", "7", None]) == ["-1", "1", "7", None]
    assert values(classes.recode(F.col("v"), {"C": -1}, F.lit(0)), ["C", "x"]) == [-1, 0]


def test_unions_and_nulls(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "b string, id long")
    merged = basics.union_by_name([a, b])
    assert merged.columns == ["id", "a", "b"]
    assert sorted(map(tuple, merged.collect()), key=str) == [(1, "x", None), (2, None, "y"), (2, None, "y")]
    assert basics.bag_union(a, a).count() == 2
    assert basics.drop_incomplete(merged, ["a"]).count() == 1
    assert basics.drop_incomplete(merged).count() == 0
    assert basics.project(merged, "id", "a", "id").columns == ["id", "a"]


def test_join_predictions_has_each_column_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "uid long, Sentence string")
    right = spark.createDataFrame([(1, "a", 0.0), (2, "b", 1.0)], "uid long, Sentence string, prediction double")
    got = basics.join_predictions(left, right)
    assert got.columns == ["Sentence", "prediction"]
    assert sorted(map(tuple, got.collect())) == [("a", 0.0), ("b", 1.0)]


def test_salted_lookup_equals_plain_join(spark):
    rng = random.Random(2)
    facts = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}") for i in range(4000)]
    df = spark.createDataFrame(facts, "doc long, term string").repartition(6)
    lookup = df.groupBy("term").agg(F.count(F.lit(1)).alias("n")).withColumn("w", F.length("term") * 1.5)
    got = joins.salted_lookup(df, lookup, "term", "n", "doc", rows_per_salt=100)
    want = df.join(lookup, "term")
    columns = ["doc", "term", "n", "w"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_labels_of_times_and_pages(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05' AS ts, 1 AS page")
    row = df.select(times.clock_label(F.col("ts")), times.page_name(F.col("page")), times.batch_start(F.col("ts"))).first()
    assert row[0] == "03:04:05" and row[1] == "rawdata_51.csv" and row[2].hour == 3
