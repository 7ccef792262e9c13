from __future__ import annotations

import hashlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from moodstream.llm import suffix
from moodstream.llm.suffix import common_prefixes, suffix_array
from moodstream.llm.suffix_dedup import suffix_dedup


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=120), st.integers(1, 5))
def test_suffix_array_and_prefixes(letters, times):
    text = np.array(letters * times, np.int32)
    order = suffix_array(text, 4)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    if len(text):
        shared, before = common_prefixes(text.astype(np.uint16), order, 0)
        for a, b in zip(order[1:].tolist(), order[:-1].tolist()):
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n] != 0:
                n += 1
            assert (shared[a], before[a]) == (n, b)


def test_more_names_than_letters():
    text = np.random.default_rng(3).integers(0, 250, 60_000).astype(np.int32)
    text[30_000:] = text[:30_000]
    raw = (text + 1).astype(np.uint8).tobytes()
    order = suffix_array(text, 250)
    assert sorted(order.tolist()) == list(range(len(text)))
    assert all(raw[a:] < raw[b:] for a, b in zip(order[:-1:7].tolist(), order[1::7].tolist()))


def brute(rows, width=100):
    """Results by document; rows with one number and one text are one document."""
    seen, out = set(), {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - width + 1):
            w = b[s : s + width]
            if w in seen:
                gone[s : s + width] = b"\1" * width
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [1000, 2])
def test_against_brute_force(llm, odd_docs, hot):
    got = suffix_dedup(odd_docs, hot=hot).collect()
    want = brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert len(got) == odd_docs.count()
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in got)


@pytest.mark.parametrize("hot", [1000, 5])
def test_common_line_in_many_contexts(llm, hot):
    line = "one very common line that stands in nearly every text and is quoted at length by all of them, word by word"
    rows = [(i, f"{hashlib.md5(b'%d' % i).hexdigest()} {line[: 60 + i % 47]} {hashlib.md5(b'x%d' % (i % 40)).hexdigest() * 3}") for i in range(120)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = brute(rows)
    for r in suffix_dedup(docs, hot=hot).collect():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]


def test_empty_table(llm, odd_docs):
    assert suffix_dedup(odd_docs.limit(0)).count() == 0


def test_registered_query_on_the_small_table(llm):
    from moodstream.llm.suffix_dedup import op3

    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op3(llm, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_many_rows_without_a_number(llm):
    """Rows without a number lose no byte that is their own; equal windows go by the text's hash, then by start."""
    pick = np.random.default_rng(11)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    shared = ["".join(pick.choice(letters, 130)) for _ in range(40)]
    texts = []
    for i in range(10_000):
        own = "".join(pick.choice(letters, 60))
        texts.append(own[: i % 50] + shared[i % 40] + own if i % 25 == 0 else own + "".join(pick.choice(letters, 70)))
    texts += texts[:50] + [None, "", "short"]
    first = {}
    raw = {(t or "").encode() for t in texts}
    named = {b: xxhash.xxh64_intdigest(b, 42) >> 18 for b in raw}
    for b in raw:
        for s in range(len(b) - 99):
            w, here = b[s : s + 100], (named[b], s)
            first[w] = min(first.get(w, here), here)
    want = {}
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] != (named[b], s):
                gone[s : s + 100] = b"\1" * 100
        want[b] = bytes(x for x, g in zip(b, gone) if not g)
    assert sum(len(b) - len(k) for b, k in want.items()) > 20_000
    docs = llm.createDataFrame([(None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, i int").repartition(4)
    got = {r.i: (r.n_bytes, r.kept_sha256) for r in suffix_dedup(docs, keep=("i",)).collect()}
    assert got == {i: (len((t or "").encode()), hashlib.sha256(want[(t or "").encode()]).hexdigest()) for i, t in enumerate(texts)}


@pytest.mark.parametrize("few", [0, 10, 1_000_000])
def test_both_ends_of_the_recursion(monkeypatch, few):
    """Names are sorted by induction above the limit and by doubled prefixes below it; the order is the same."""
    monkeypatch.setattr(suffix, "_FEW_NAMES", few)
    induced = []
    sort = suffix._induced_sort
    monkeypatch.setattr(suffix, "_induced_sort", lambda text, letters: induced.append(len(text)) or sort(text, letters))
    for seed, top in ((1, 3), (2, 250), (3, 4000)):
        text = np.random.default_rng(seed).integers(0, top, 20_000).astype(np.int32)
        text[12_000:] = text[:8_000]
        order = suffix_array(text, top)
        letters = text.tolist()
        assert sorted(order.tolist()) == list(range(len(text)))
        assert all(letters[a:] < letters[b:] for a, b in zip(order[:-1:37].tolist(), order[1::37].tolist()))
    assert len(induced) > 3 if few <= 10 else len(induced) == 3


def test_single_windows_under_one_anchor_are_told_apart_by_their_bytes(llm):
    """Rows that carry one key and different bytes are no copies of each other."""
    key, width = 5, 100
    a, b = bytes(range(100)), bytes(range(100, 200))
    rows = [(key, d, d << 30 | 1, 0, seg) for d, seg in enumerate([a, b, a, b, a, a])]
    hot = llm.createDataFrame([(k, d, at, bytearray(seg), 1) for k, d, at, _, seg in rows], "key long, d long, at long, seg binary, pieces long")
    ranked = hot.withColumn("nth", F.row_number().over(Window.partitionBy("key", "seg", "pieces").orderBy("d", "at")))
    assert sorted(r.d for r in ranked.where("nth > 1").collect()) == [2, 3, 4, 5]
    docs = llm.createDataFrame([(d, (chr(97 + d % 2) * 100) + f"{d:03d}" * 40) for d in range(40)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup(docs, hot=2, width=width).collect()}
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got == {d: w[1] for d, w in want.items()}
