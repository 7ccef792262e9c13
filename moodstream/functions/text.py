"""Text cleaning and tokenising with built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodstream.functions.binding import let

# The patterns and the short word list the results depend on.
MENTION = r"@[\p{L}\p{N}_]+"
WHITESPACE = r"\s"
NON_WORD = r"\W"
NON_WORD_UNICODE = r"(?U)\W"
LATIN1_ONLY = r"\A[\x00-ÿ]*\z"
STOP_WORDS = ("http", "https", "amp", "rt", "t", "c", "the")


_HELD = "\x00fffd\x00"


def strip_mentions(text: Column) -> Column:
    """Remove ``@name`` marks; a name is letters, digits and underscores of any script."""
    # Most texts have no mark at all, and looking for one byte is far cheaper than the pattern.
    return F.when(text.contains("@"), F.regexp_replace(text, MENTION, "")).otherwise(text)


def drop_unencodable(text: Column) -> Column:
    """Remove byte sequences that are not UTF-8; valid text is returned unchanged.

    A replacement character that the text has itself stays: it is held apart while the broken bytes,
    which become replacement characters too, are removed.
    """
    held = F.replace(text, F.lit("\ufffd"), F.lit(_HELD))
    kept = F.translate(F.make_valid_utf8(held), "\ufffd", "")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.replace(kept, F.lit(_HELD), F.lit("\ufffd")))


def clean_comment(text: Column) -> Column:
    return strip_mentions(drop_unencodable(text))


def garble(text: Column) -> Column:
    """UTF-8 bytes read as Latin-1: the damage ``repair_encoding`` undoes."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def repair_encoding(text: Column) -> Column:
    """Undo UTF-8 text that was read as Latin-1; anything else is returned unchanged."""
    as_bytes = F.encode(text, "ISO-8859-1").cast("string")
    fixed = F.when(text.rlike(LATIN1_ONLY), F.try_validate_utf8(as_bytes))
    return F.coalesce(fixed, text)


def decode_bytes(value: Column) -> Column:
    """UTF-8 bytes to text; null where the bytes are not UTF-8, so they can be set aside."""
    return F.try_validate_utf8(value.cast("string"))


def tokens(text: Column, pattern: str = WHITESPACE) -> Column:
    """Lower-cased pieces between matches of ``pattern``, without empty ones."""
    return F.filter(F.split(F.lower(text), pattern), lambda t: F.length(t) >= 1)


def remove_words(words: Column, stop: Sequence[str] = STOP_WORDS) -> Column:
    """Drop tokens equal to a stop word, ignoring case."""
    listed = sorted({w.strip().lower() for w in stop if w.strip()})
    if not listed:
        return words
    return F.filter(words, lambda t: ~F.lower(t).isin(listed))


def _indexes(words: Column, start: int) -> Column:
    # An empty array has no positions, while sequence() would count down.
    last = F.size(words) - 1 + start
    return F.when(F.size(words) == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(start), last)
    )


def remove_phrases(words: Column, phrases: Sequence[str]) -> Column:
    """Drop every token that lies inside an occurrence of a listed phrase, ignoring case.

    Phrases are one or more words separated by blanks. Overlapping occurrences all count. Phrases
    are grouped by length, so the cost is one set lookup per token and phrase length.
    """
    by_length: dict[int, set[str]] = {}
    for phrase in phrases:
        parts = phrase.lower().split()
        if parts:
            by_length.setdefault(len(parts), set()).add(" ".join(parts))
    if not by_length:
        return words

    def covered(lowered: Column, length: int, listed: list[str]) -> Column:
        first_words = sorted({p.split()[0] for p in listed})
        # The first word is looked up alone, so only few positions build the whole phrase.
        starts = F.filter(
            _indexes(lowered, 1),
            lambda i: F.get(lowered, i - 1).isin(first_words)
            & F.array_join(F.slice(lowered, i, F.lit(length)), " ").isin(listed),
        )
        return F.flatten(F.transform(starts, lambda i: F.sequence(i, i + (length - 1))))

    def kept(lowered: Column) -> Column:
        parts = [covered(lowered, n, sorted(listed)) for n, listed in sorted(by_length.items())]
        # array_except also drops duplicates; positions are unique, so nothing else is lost.
        return F.array_except(_indexes(lowered, 1), F.concat(*parts))

    def remaining(tokens_once: Column) -> Column:
        positions = let(F.transform(tokens_once, F.lower), kept)
        return F.transform(positions, lambda i: F.get(tokens_once, i - 1))

    return let(words, remaining)


def term_counts(words: Column) -> Column:
    """Array of ``(term, tf)`` structs of one document, computed inside its row.

    Equal tokens are brought together by sorting and counted from the positions where a new term
    starts, so counting needs no shuffle on (document, term).
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            _indexes(ordered, 0),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda i, n: F.struct(
                    F.get(ordered, i).alias("term"),
                    (F.coalesce(F.get(at, n + 1), F.size(ordered)) - i).cast("long").alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(words), runs)
