from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from moodstream.operators import sketches

SCHEMA = "batch int, UserID string, class string, users string, comments string"


def rows_of(n, users, seed=1):
    pick = random.Random(seed)
    return [(pick.randrange(40), f"u{int(pick.random() ** 2 * users)}", pick.choice(["positive", "positive", "negative", "neutral"]), "x", "y") for _ in range(n)]


ODD = [(0, None, "negative", "x", "y"), (3, "u1", None, "x", "y"), (39, "late", "neutral", "x", "y"), (None, "u2", "positive", "x", "y")]


def by_hand(rows):
    """Distinct users and comments up to every batch and class; a null batch comes first."""
    out = {}
    for cls in {r[2] for r in rows} - {None}:
        users, n = set(), 0
        own = defaultdict(list)
        for r in rows:
            if r[2] == cls:
                own[r[0]].append(r[1])
        for batch in sorted(own, key=lambda b: (b is not None, b)):
            users |= set(own[batch]) - {None}
            n += len(own[batch])
            out[batch, cls] = (n, len(users))
    return out


@pytest.fixture(scope="module", params=[(300, 50), (40_000, 30_000)])
def data(request, spark):
    rows = rows_of(*request.param) + ODD
    return rows, spark.createDataFrame(rows, SCHEMA)


def block():
    return F.floor(F.coalesce("batch", F.lit(-1)) / 7)


def test_exact(data):
    rows, df = data
    got = {(r["batch"], r["class"]): r["users"] for r in sketches.running_users_exact(df.filter("batch is not null"), "batch", block()).collect()}
    assert got == {k: v[1] for k, v in by_hand([r for r in rows if r[0] is not None]).items()}


def test_estimates_are_within_the_bound_at_every_prefix(data):
    rows, df = data
    kept = sketches.user_sketches(df.filter("batch is not null"), "batch")
    want = by_hand([r for r in rows if r[0] is not None])
    got = {(r["batch"], r["class"]): (r["comments"], r["users"]) for r in sketches.running_users(kept, "batch", block()).collect()}
    assert set(got) == set(want)
    for k, (n, users) in want.items():
        assert got[k][0] == n and abs(got[k][1] - users) <= sketches.relative_error() * users + 0.5


def test_blocks_do_not_change_the_merge(data):
    _, df = data
    kept = sketches.user_sketches(df.filter("batch is not null"), "batch").persist()
    tables = [sorted(map(tuple, sketches.running_users(kept, "batch", F.floor(F.col("batch") / n)).collect())) for n in (1, 5, 100)]
    kept.unpersist()
    # Merging in another order moves an estimate by rounding only.
    assert all(abs(a[3] - b[3]) <= 1 + 0.02 * a[3] and a[:3] == b[:3] for t in tables[1:] for a, b in zip(tables[0], t))


def test_any_range_of_batches(data):
    rows, df = data
    kept = sketches.user_sketches(df, "batch")
    got = {r["class"]: (r["comments"], r["users"]) for r in sketches.users_in_range(kept, "batch", 5, 11).collect()}
    for cls, (n, users) in got.items():
        own = [r[1] for r in rows if r[2] == cls and r[0] is not None and 5 <= r[0] <= 11]
        assert n == len(own) and abs(users - len(set(own))) <= sketches.relative_error() * len(set(own)) + 0.5


def test_a_batch_that_comes_again_changes_no_count_of_users(data):
    _, df = data
    once = sketches.user_sketches(df.filter("batch = 4"), "batch")
    a = sorted(sketches.users_in_range(once, "batch", 4, 4).select("class", "users").collect())
    b = sorted(sketches.users_in_range(once.unionAll(once), "batch", 4, 4).select("class", "users").collect())
    # A single sketch is estimated from the order of its rows too, a merged one from its registers alone.
    assert len(a) == len(b) and all(x[0] == y[0] and abs(x[1] - y[1]) <= sketches.relative_error() * x[1] for x, y in zip(a, b))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sketches.running_users(sketches.user_sketches(empty, "batch"), "batch", block()).collect() == []
    assert sketches.running_users_exact(empty, "batch", block()).collect() == []
