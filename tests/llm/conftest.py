from __future__ import annotations

import pytest

from moodstream.llm.common import ship

WORDS = "the quick brown fox jumps over a lazy dog while seven grey geese fly past old stone mills every cold bright morning".split()


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 2654435761 % 2**32 or 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x // 65536 % len(WORDS)])
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls, empty and very long texts, ties, repeated rows and columns whose names clash with inner ones."""
    long = sentence(1, 30_000)
    rows = [
        (1, sentence(2, 60)), (2, None), (3, ""), (4, long), (5, sentence(2, 60)), (5, sentence(2, 60)),
        (6, "x"), (None, sentence(2, 60) + " more"), (7, sentence(3, 40) + " " + long[500:900]), (8, "é" * 300), (9, "aé" + "é" * 300),
        (10, "   \n\t "), (11, "AB" * 200), (12, "ab"), (-3, "negative " + sentence(4, 50)), (13, "<|endoftext|> it's ΣΑΣ \x1c中文"),
    ]
    return llm.createDataFrame(
        [(i, t, "en", None, 1, 1, "r", 0.5, 7) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, d long, row string, score double, key long",
    )
