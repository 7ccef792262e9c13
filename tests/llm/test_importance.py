from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moodstream.llm.importance import bucket_counts, least_reaching, resample, run_buckets

TEXT = st.text(alphabet="abAZ09 .\n\x00é中", max_size=30) | st.text(max_size=12)


def runs(text, buckets):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def by_hand(docs, target, percent, min_words, buckets):
    """(id, n_features, weight, score) of every row and, by rank, the drawn ones."""
    s, t = Counter(b for _, x in docs for b in runs(x, buckets)[1]), Counter(b for x in target for b in runs(x, buckets)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows, fit = [], []
    for i, x in docs:
        words, found = runs(x, buckets)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        row = (i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
        rows.append(row)
        if len(words) >= min_words:
            fit.append(row)
    fit.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    return rows, fit[: percent * len(fit) // 100]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_registers_are_crc32(texts):
    raw = [t.encode("utf-8", "replace") for t in texts]
    borders = np.cumsum([0, *map(len, raw)])
    text, bucket, words = run_buckets(np.frombuffer(b"".join(raw), np.uint8), borders, 10_000)
    for i, t in enumerate(raw):
        want_words, want = runs(t.decode(), 10_000)
        assert words[i] == len(want_words) and Counter(bucket[text == i].tolist()) == Counter(want)


@pytest.mark.parametrize("size", [63, 64, 65, 1000, 70_001])
def test_long_words(size):
    raw = b"a " + b"q" * size + b" b " + b"z" * (size + 1)
    _, bucket, _ = run_buckets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 10_000)
    assert Counter(bucket.tolist()) == Counter(runs(raw.decode(), 10_000)[1])


@pytest.mark.parametrize("percent,min_words", [(30, 20), (100, 1), (5, 20)])
def test_against_brute_force_on_odd_rows(llm, odd_docs, percent, min_words):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    target = ["the quick brown fox", None, "", "a lazy dog and a fox"]
    table = llm.createDataFrame([(t, i) for i, t in enumerate(target)], "text string, doc_id int")
    got = resample(odd_docs, table, percent, min_words, buckets=500, keep=("row", "lang")).collect()
    rows, drawn = by_hand(docs, target, percent, min_words, 500)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(rows)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [(r.doc_id, r.n_features, r.weight, r.score) for r in ranked] == drawn
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1)) and {r.row for r in got} == {"r"}


def test_ties_at_the_limit_go_by_id_and_then_by_copy(llm):
    text = " ".join(["word"] * 20)
    docs = [(7, text)] * 30 + [(None, text)] * 10
    rows = resample(llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame([("word",)], "text string"), 50, 20).collect()
    _, drawn = by_hand(docs, ["word"], 50, 20, 10_000)
    assert Counter(r.doc_id for r in rows if r["rank"] is not None) == Counter(r[0] for r in drawn) and len(drawn) == 20
    assert sorted(r["rank"] for r in rows if r["rank"] is not None) == list(range(1, 21))


@pytest.mark.parametrize("ways", [2, 3, 16])
def test_bisection(llm, ways):
    values = [5, -(2**40), 5, 5, 9, 2**40, 5, -3]
    rows = llm.createDataFrame([(v,) for v in values], "v long")
    assert [least_reaching(rows, "v", n, ways) for n in range(1, len(values) + 1)] == sorted(values)


def test_empty_tables(llm, odd_docs):
    target = llm.createDataFrame([("the fox",)], "text string")
    assert resample(odd_docs.limit(0), target).collect() == []
    assert bucket_counts(odd_docs.limit(0)).collect() == []
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = resample(odd_docs.select("doc_id", "text"), target.limit(0), 30).collect()
    rows, drawn = by_hand(docs, [], 30, 20, 10_000)
    assert Counter(tuple(r)[:4] for r in got) == Counter(rows) and sum(r["rank"] is not None for r in got) == len(drawn)
