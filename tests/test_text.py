from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from moodstream.functions import text


@pytest.fixture
def V(spark):
    return F.col("v")



def test_mentions_equal_unicode_word_rule(values, V):
    samples = [
        "@an hello", "hello @an", "a @Đức_1 b", "@", "@@.m", "me@mail.com", "", "no mention",
        "@đặng và @lê", "x @日本語 y", "@name's", "đẹp quá @ 😀",
    ]
    want = [re.sub(r"@\w+", "", s) for s in samples]
    assert values(text.strip_mentions(V), samples) == want


def test_mentions_of_null_stay_null(values, V):
    assert values(text.strip_mentions(V), [None]) == [None]


def test_repair_undoes_latin1_reading(values, V):
    good = ["đẹp quá", "xin chào 😀", "plain", "", "ñandú"]
    damaged = [s.encode("utf-8").decode("latin-1") for s in good]
    assert values(text.repair_encoding(V), damaged) == good


def test_repair_leaves_other_text_alone(values, V):
    # True Latin-1 text whose bytes are not UTF-8, text beyond Latin-1, and null.
    samples = ["café", "日本", "đẹp", None]
    assert values(text.repair_encoding(V), samples) == samples


def test_garble_and_repair(values, V):
    samples = ["đẹp quá\nnăm", "é", "😀"]
    assert values(text.repair_encoding(text.garble(V)), samples) == samples


def test_bad_bytes(values, V):
    rows = [b"ok", b"a\xffb", "đ".encode()]
    assert values(text.decode_bytes(V), rows, "binary") == ["ok", None, "đ"]
    assert values(text.drop_unencodable(V.cast("string")), rows, "binary") == ["ok", "ab", "đ"]


def test_valid_replacement_character_is_kept(values, V):
    assert values(text.drop_unencodable(V), ["a�b"]) == ["a�b"]


def test_tokens(values, V):
    assert values(text.tokens(V), ["A  b\tC\n", "", "   ", None, "x　y"]) == [
        ["a", "b", "c"], [], [], None, ["x　y"]
    ]
    assert values(text.tokens(V, text.NON_WORD), ["Không được"]) == [["kh", "ng", "c"]]
    assert values(text.tokens(V, text.NON_WORD_UNICODE), ["Không được!"]) == [["không", "được"]]


def test_stop_words_ignore_case(values, V):
    words = F.split(V, " ")
    assert values(text.remove_words(words), ["The cat http T rt dog"]) == [["cat", "dog"]]
    assert values(text.remove_words(words, []), ["the cat"]) == [["the", "cat"]]
    # An entry with a blank or a line end can never equal a token.
    assert values(text.remove_words(words, ["a ha\n"]), ["a ha"]) == [["a", "ha"]]


def _without_phrases(words, phrases):
    gone = set()
    for phrase in phrases:
        parts = phrase.lower().split()
        for i in range(len(words) - len(parts) + 1):
            if [w.lower() for w in words[i : i + len(parts)]] == parts:
                gone.update(range(i, i + len(parts)))
    return [w for i, w in enumerate(words) if i not in gone]


def test_phrases_against_brute_force(values, V):
    rng = random.Random(3)
    texts = [" ".join(rng.choices("a b c A d".split(), k=rng.randrange(1, 40))) for _ in range(60)]
    phrases = ["a b", "b a", "c c", "a b c", "d"]
    got = values(text.remove_phrases(F.split(V, " "), phrases), texts)
    assert got == [_without_phrases(t.split(" "), phrases) for t in texts]


def test_phrases_on_edges(values, V):
    words = text.tokens(V)
    assert values(text.remove_phrases(words, ["a ha"]), ["", "a", "a ha", "ha a", None]) == [
        [], ["a"], [], ["ha", "a"], None
    ]


def test_term_counts_against_counter(values, V):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("a b c đ e".split(), k=n)) for n in (1, 2, 7, 500)] + [""]
    got = values(text.term_counts(text.tokens(V)), texts)
    assert [{r["term"]: r["tf"] for r in rows} for rows in got] == [dict(Counter(t.split())) for t in texts]
    assert all(len(rows) == len({r["term"] for r in rows}) for rows in got)


def test_hot_term_in_one_document(values, V):
    # One term fills most of a long text.
    got = values(text.term_counts(text.tokens(V)), ["x " * 20_000 + "y"])
    assert {r["term"]: r["tf"] for r in got[0]} == {"x": 20_000, "y": 1}
