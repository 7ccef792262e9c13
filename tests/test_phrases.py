from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodstream.functions.phrases import PhraseTrie, phrase_remover
from moodstream.functions.text import remove_phrases

WORD = st.sampled_from(["a", "b", "c", "A", "é", "dd"])
PHRASE = st.lists(WORD, min_size=1, max_size=5).map(" ".join)


def by_hand(words, phrases):
    low, gone = [w.lower() for w in words], set()
    for phrase in phrases:
        parts = phrase.lower().split()
        for i in range(len(low) - len(parts) + 1 if parts else 0):
            if low[i : i + len(parts)] == parts:
                gone.update(range(i, i + len(parts)))
    return [w for i, w in enumerate(words) if i not in gone]


@settings(max_examples=500, deadline=None)
@given(st.lists(WORD, max_size=25), st.lists(PHRASE, max_size=8))
def test_against_brute_force(words, phrases):
    kept = PhraseTrie(phrases).kept(words)
    assert (words if kept is None else kept) == by_hand(words, phrases)


def test_phrases_inside_and_across_each_other():
    trie = PhraseTrie(["a b c d e", "b c", "c d x", "x", "  ", ""])
    assert trie.ends("a b c d e".split()) == [0, 0, 2, 0, 5]
    assert trie.kept("a b c d x y".split()) == ["a", "y"]
    assert PhraseTrie([]).kept(["a"]) is None and PhraseTrie(["a"]).kept([]) is None


def test_cost_does_not_grow_with_the_phrases():
    """Steps taken per token stay below two, however many phrases there are: every fallback undoes an earlier step."""
    words = [f"w{i * i % 97}" for i in range(5000)]
    for n in (10, 10_000):
        trie, steps = PhraseTrie([f"w{i % 97} w{i * 7 % 97} w{i * 3 % 89} q{i}" for i in range(n)]), 0
        node = 0
        for word in words:
            while node and word not in trie.step[node]:
                node, steps = trie.fallback[node], steps + 1
            node, steps = trie.step[node].get(word, 0), steps + 1
        assert steps <= 2 * len(words)


def test_columns(spark):
    phrases = ["in the", "THE house", "of the day", "x"]
    texts = [["in", "The", "house", "we"], [], None, ["x", "X"], ["of", "the", None or "day", "in"], ["in", "the"] * 3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, words array<string>")
    remove = phrase_remover(spark, phrases)
    out = df.select("i", remove(F.col("words")).alias("trie"), remove_phrases(F.col("words"), phrases).alias("sets")).orderBy("i").collect()
    assert [r["trie"] for r in out] == [None if t is None else by_hand(t, phrases) for t in texts]
    assert all(r["trie"] == r["sets"] for r in out)
    assert df.limit(0).select(remove(F.col("words"))).collect() == []


def test_a_list_that_is_too_large_is_refused(spark):
    with pytest.raises(ValueError, match="bytes"):
        phrase_remover(spark, ["one two"], limit=10)
