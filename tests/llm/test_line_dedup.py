from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from moodstream.llm.line_dedup import SPACE, drop_common_lines, first_occurrences, keep_bitmaps, line_hashes

SCHEMA = "doc_id long, text string, pos int, keep string, name string, part int, h1 long, doc string"


def rows_of(llm, docs):
    return llm.createDataFrame([(i, t, 1, "k", "n", 2, 3, "d") for i, t in docs], SCHEMA)


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def by_hand(docs, min_docs, min_chars=1):
    found = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            found[key(line)].add(i)
    common = {k for k, ids in found.items() if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [line for line in lines if key(line) not in common]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def run(llm, docs, *args, **more):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in drop_common_lines(rows_of(llm, docs), *args, **more).collect())


ODD = [
    (1, "Same line\nown 1\n\nsame LINE\t"), (2, "  same line\r\nown 2"), (3, "same line"), (4, None), (5, ""), (6, "\n\n"), (7, "own\n"),
    (8, "ÄHNLICH\nähnlich"), (9, "ähnlich"), (10, "ÄHNLICH"), (11, "\xa0same line"), (None, "same line\nnull id"), (None, "same line"), (3, "same line"),
    (3, "same line\nmore of three"), (12, "x\ny\nx"), (13, "x"), (14, "X \x0b\x0c"), (15, "same line\n" * 3), (-1, "\x00\nx"), (16, "\x1cx"),
]


@pytest.mark.parametrize("min_docs,min_chars", [(3, 1), (2, 1), (1, 1), (3, 5), (50, 1)])
def test_against_brute_force(llm, min_docs, min_chars):
    assert run(llm, ODD, min_docs, min_chars) == by_hand(ODD, min_docs, min_chars)


def test_a_line_that_most_documents_share_lies_in_several_ranges(llm):
    docs = [(i, f"own {i}\nhot line\nlast {i % 20}") for i in range(4000)]
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = first_occurrences(line_hashes(rows_of(llm, docs)))
    finally:
        llm.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = placed.groupBy("h1").agg(F.count("*").alias("n"), F.count_distinct("part").alias("parts")).where("n = 4000").first()
    assert hot.parts > 1
    assert run(llm, docs) == by_hand(docs, 10)


def test_ranges_serve_the_window_without_another_shuffle(llm):
    lines = line_hashes(rows_of(llm, ODD)).repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos", "name")
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("h1", "h2", "doc").orderBy("pos"))
    plan = lines.select("*", nth.alias("nth"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and "Python" not in plan


def test_long_document_and_sparse_bitmap(llm):
    many = "\n".join(f"line {i}" if i % 1000 else "common" for i in range(100_000))
    docs = [(0, many), *[(i, f"common\nown {i}") for i in range(1, 12)]]
    assert run(llm, docs) == by_hand(docs, 10)
    longest = keep_bitmaps(rows_of(llm, docs)).where("doc = 0").first()
    assert longest.n_dropped == 100 and len(longest["keep"]) == 100  # of 1,563 words
    assert all(w.bits == ~(1 << (w.word * 64 + 63) // 1000 * 1000 % 64) or bin(w.bits & (2**64 - 1)).count("0") == 2 for w in longest["keep"])


def test_the_last_line_of_a_word(llm):
    docs = [(0, "\n".join("common" if i in (63, 64, 127) else f"l{i}" for i in range(130))), *[(i, "common") for i in range(1, 12)]]
    assert run(llm, docs) == by_hand(docs, 10)


def test_empty_table(llm):
    assert run(llm, []) == Counter()


def test_no_python_worker(llm):
    plan = drop_common_lines(rows_of(llm, ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
