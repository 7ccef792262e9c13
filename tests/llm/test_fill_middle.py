from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodstream.llm.fill_middle import UNIT, cut, fill_in_middle, restored

TEXT = st.text(alphabet="ab \t\n\x0b\x1c\xa0é<PSM>", max_size=40) | st.text(max_size=20)


def by_hand(doc_id, text, fim=50, spm=80, seed=42):
    text = text or ""
    units = re.findall(UNIT, text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cuts_are_those_of_the_units(text, h1, h2):
    units = re.findall(UNIT, text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    assert "".join(units) == text
    assert cut(text, h1, h2) == (len(units), sum(map(len, units[:a])), sum(map(len, units[:b])))


@pytest.mark.parametrize("text", ["x" * 1_000_000, " " * 1_000_000, "a " * 300_000, "\n" * 1000 + "é" * 1_000_000 + "\n"])
def test_very_long_texts(text):
    n, a, b = cut(text, 2**32 - 1, 7)
    assert n == len(re.findall(UNIT, text)) and 0 <= a <= b <= len(text)


@pytest.mark.parametrize("fim,spm", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_odd_rows_and_round_trip(llm, odd_docs, fim, spm):
    more = [(100 + i, t, "en", None, 1, 1, "r", 0.5, 7) for i, t in enumerate(
        ["a <P> b", "<S>", "x <M", "<<S", "P>", "a <P", "b<", "<S <S", ">", "M> c <", " lead", "trail ", "\x00 z", "a\x85b"] * 6)]
    docs = odd_docs.unionAll(llm.createDataFrame(more, odd_docs.schema))
    out = fill_in_middle(docs, fim_percent=fim, spm_percent=spm, keep=("row", "key")).withColumn("back", restored(F.col("output"), F.col("form")))
    rows = out.collect()
    want = Counter((r["doc_id"], *by_hand(r["doc_id"], r["text"], fim, spm), r["text"] or "") for r in docs.collect())
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in rows) == want
    assert {(r.row, r.key) for r in rows} == {("r", 7)}


def test_small_batches_keep_rows_apart(llm, odd_docs, monkeypatch):
    monkeypatch.setattr("moodstream.llm.fill_middle._BATCH_CHARS", 10)
    assert fill_in_middle(odd_docs).count() == odd_docs.count()


def test_empty_table(llm, odd_docs):
    assert fill_in_middle(odd_docs.limit(0)).collect() == []


def test_shares(llm):
    docs = llm.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"))
    n = {r.form: r["count"] for r in fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(n["plain"] - 2000) < 200 and abs(n["spm"] - 1600) < 200 and abs(n["psm"] - 400) < 120
