"""Windows that are written once, late rows that are kept apart, sessions, and a state that does not grow."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest

from moodstream.sources.stream import file_stream
from moodstream.streaming import jobs, results

SCHEMA = "id long, ts timestamp, UserID string, class string, n long, window_start string"
START = datetime(2026, 1, 1, tzinfo=timezone.utc)
HOUR = timedelta(hours=1)


def row(i, minutes, cls="positive", user=None):
    return (i, START + timedelta(minutes=minutes) if minutes is not None else None, user or f"u{i % 3}", cls, 9, "w")


PAGES = [
    [row(i, i * 4, "negative" if i % 4 == 0 else "positive") for i in range(60)] + [row(900, None), row(901, 10, None)],  # four hours
    [row(100 + i, 200 + i * 3) for i in range(60)],  # to 06:17; nothing here is late yet by more than its window
    [row(200, 5), row(201, 5), row(202, 119, "negative"), row(203, 299), row(204, 380), row(205, 377, None)],  # late, late, late, in time
    [row(300, 900), row(301, 381)],
    [row(400, 839), row(401, 901), row(402, 780)],  # 13:59 is late after 15:00, as is 13:00; 15:01 is not
]


def late_by_hand(pages, delay=HOUR):
    """Ids of late rows, and the watermark after all pages."""
    mark, late = None, []
    for page in pages:
        rows = [r for r in page if r[1] is not None and r[3] is not None]
        for r in rows:
            end = r[1].replace(minute=0, second=0) + HOUR
            if mark is not None and end <= mark:
                late.append(r[0])
        reached = max((r[1] for r in rows), default=None)
        if reached is not None:
            mark = max(mark or reached - delay, reached - delay)
    return late, mark


def write(spark, path, pages):
    for page in pages:
        spark.createDataFrame(page, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, out, start=jobs.start_final_windows, **more):
    stream = file_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, "parquet", files_per_batch=1)
    query = start(stream, out, out + "-checkpoint", **more)
    results.run_to_end(query)
    return query


@pytest.mark.parametrize("restart_after", [None, 2])
def test_every_row_is_in_one_table(spark, tmp_path, restart_after):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, path, PAGES[:restart_after])
    run(spark, path, out)
    if restart_after:
        write(spark, path, PAGES[restart_after:])
        run(spark, path, out)
    late, mark = late_by_hand(PAGES)
    assert sorted(r["id"] for r in spark.read.parquet(f"{out}/late").collect()) == sorted(late) and len(late) >= 4
    want = defaultdict(Counter)
    for page in PAGES:
        for r in page:
            if r[1] is not None and r[3] is not None:
                begin = r[1].replace(minute=0, second=0)
                kind = "late" if r[0] in late else "final" if begin + HOUR <= mark else "open"
                want[kind][begin.replace(tzinfo=None), r[3]] += 1
    got = defaultdict(Counter)
    for r in results.window_tables(spark, out).selectExpr("cast(window_start as timestamp_ntz) w", "class", "kind", "n").collect():
        assert (r["w"], r["class"]) not in got[r["kind"]]  # a window is final once
        got[r["kind"]][r["w"], r["class"]] = r["n"]
    assert got == want


def test_a_micro_batch_that_runs_again(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, path, PAGES)
    run(spark, path, out)
    want = sorted(map(tuple, results.window_tables(spark, out).collect()), key=str)
    for name in (f"{len(PAGES) - 1}", f".{len(PAGES) - 1}.crc"):
        (tmp_path / "out-checkpoint" / "commits" / name).unlink(missing_ok=True)
    run(spark, path, out)
    assert sorted(map(tuple, results.window_tables(spark, out).collect()), key=str) == want


def test_what_is_carried_over_does_not_grow(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages = [[row(p * 100 + i, p * 180 + i * 6) for i in range(30)] for p in range(6)]
    write(spark, path, pages)
    run(spark, path, out)
    held = {r["epoch"]: r["count"] for r in spark.read.parquet(f"{out}/open").groupBy("epoch").count().collect()}
    assert max(held.values()) <= 3 and len(held) == 6


def test_sessions(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    times = [0, 10, 39, 69.5, 120, 121, 400, 1000]
    rows = [row(i, m, "negative" if i % 2 else "positive", "a") for i, m in enumerate(times)] + [row(50, 15, None, "b"), (51, START, None, "positive", 1, "w")]
    pages = [sorted((r for r in rows if lo <= (r[1] - START).total_seconds() / 60 < hi), key=lambda r: r[1]) for lo, hi in ((0, 60), (60, 300), (300, 2000))]
    write(spark, path, pages)
    query = run(spark, path, out, jobs.start_sessions, state_partitions=2)
    got = {(r["UserID"], r["started"].strftime("%H:%M"), r["ended"].strftime("%H:%M"), r["n"], r["negative"]) for r in spark.read.parquet(out).selectExpr(
        "UserID", "cast(started as timestamp_ntz) started", "cast(ended as timestamp_ntz) ended", "n", "negative").collect()}
    # The half-minute gap under thirty keeps 00:39 and 01:09:30 apart; the last session is still open.
    assert got == {("a", "00:00", "01:09", 3, 1), ("a", "01:09", "01:39", 1, 1), ("a", "02:00", "02:31", 2, 1), ("a", "06:40", "07:10", 1, 0), ("b", "00:15", "00:45", 1, 0)}
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_built_in_window_counts_leave_the_state(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, path, [[row(p * 100 + i, p * 180 + i * 6) for i in range(30)] for p in range(6)])
    query = run(spark, path, out, jobs.start_window_counts, state_partitions=2)
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes) <= 7 and sizes[-1] <= 2
    assert results.latest_values(spark, out, ["window_start", "class"]).groupBy().sum("n").first()[0] == 180


def test_empty_stream(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, path, [PAGES[0][:1]])
    empty = str(tmp_path / "none")
    spark.read.parquet(path).limit(0).write.parquet(empty)
    run(spark, empty, out)
    write(spark, empty, [[row(1, 5)]])
    run(spark, empty, out)
    assert [(r["kind"], r["n"]) for r in results.window_tables(spark, out).collect()] == [("open", 1)]
