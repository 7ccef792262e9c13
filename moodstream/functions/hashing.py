"""Murmur3 of text in column expressions: the bucket of a term without a feature transformer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodstream.functions.binding import let

# The constants of Murmur3 for 32 bits, and the seed of Spark's hashed features.
SEED = 42
K_FACTORS = (0xCC9E2D51, 0x1B873593)
H_ADDEND = 0xE6546B64
END_FACTORS = (0x85EBCA6B, 0xC2B2AE35)
#: What undoes a product with the factors above.
END_INVERSES = tuple(pow(f, -1, 1 << 32) for f in END_FACTORS)
MASK = 0xFFFFFFFF


def _times(a: Column, factor: int) -> Column:
    """Low 32 bits of a product. The factor goes in halves, so no product passes 48 bits."""
    low = a * F.lit(factor & 0xFFFF)
    high = F.shiftleft((a * F.lit(factor >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)
    return (low + high).bitwiseAND(F.lit(MASK))


def _turned(a: Column, bits: int) -> Column:
    """32 bits turned to the left."""
    return F.shiftleft(a, bits).bitwiseAND(F.lit(MASK)).bitwiseOR(F.shiftright(a, 32 - bits))


def _folded(a: Column, bits: int) -> Column:
    return a.bitwiseXOR(F.shiftright(a, bits))


def _chain(value: Column, *steps: Callable[[Column], Column]) -> Column:
    """The steps one after the other, each result computed once."""
    for step in steps:
        value = let(value, step)
    return value


def _little_endian(digits: Column) -> Column:
    """The number whose four bytes stand in eight hexadecimal digits, lowest byte first."""
    return let(
        F.conv(digits, 16, 10).cast("long"),
        lambda w: F.shiftleft(w.bitwiseAND(F.lit(0xFF)), 24)
        .bitwiseOR(F.shiftleft(w.bitwiseAND(F.lit(0xFF00)), 8))
        .bitwiseOR(F.shiftright(w, 8).bitwiseAND(F.lit(0xFF00)))
        .bitwiseOR(F.shiftright(w, 24)),
    )


def _mixed(word: Column) -> Column:
    return _chain(word, lambda k: _times(k, K_FACTORS[0]), lambda k: _turned(k, 15), lambda k: _times(k, K_FACTORS[1]))


def murmur3(text: Column, seed: int = SEED) -> Column:
    """Unsigned 32-bit Murmur3 of the text's UTF-8 bytes; null for null.

    Unlike ``F.hash``, which takes every byte behind the last whole word for a word of its own, the last one to three
    bytes count as one word, as Spark's hashed features have it.
    """

    def whole(digits: Column) -> Column:
        words = F.floor(F.length(digits) / 8).cast("int")
        numbers = F.when(words > 0, F.sequence(F.lit(0), words - 1)).otherwise(F.array().cast("array<int>"))
        mixed = F.aggregate(
            numbers,
            F.lit(seed).cast("long"),
            lambda h, i: let(
                h.bitwiseXOR(_mixed(_little_endian(F.substr(digits, i * 8 + 1, F.lit(8))))),
                lambda x: (_turned(x, 13) * 5 + H_ADDEND).bitwiseAND(F.lit(MASK)),
            ),
        )
        # No byte left mixes to zero.
        tail = F.rpad(F.substr(digits, words * 8 + 1, F.lit(8)), 8, "0")
        size = F.floor(F.length(digits) / 2).cast("long")
        return _chain(
            mixed.bitwiseXOR(_mixed(_little_endian(tail))).bitwiseXOR(size),
            lambda h: _folded(h, 16), lambda h: _times(h, END_FACTORS[0]),
            lambda h: _folded(h, 13), lambda h: _times(h, END_FACTORS[1]),
            lambda h: _folded(h, 16),
        )

    return F.when(text.isNotNull(), let(F.hex(text.cast("binary")), whole))


def _remainder(h: Column, buckets: int) -> Column:
    signed = F.when(h > F.lit(0x7FFFFFFF), h - F.lit(1 << 32)).otherwise(h)
    return F.pmod(signed, F.lit(buckets)).cast("int")


def term_bucket(term: Column, buckets: int) -> Column:
    """Bucket of a term among ``buckets``: the remainder of the hash as a signed number, made non-negative."""
    return let(murmur3(term), lambda h: _remainder(h, buckets))


def term_buckets(terms: Column, buckets: int) -> Column:
    """``term_bucket`` of every term of an array, in some order and at less than half the time.

    ``F.hash`` agrees with Murmur3 on whole words, so terms of whole words are done with it. Of the others it takes all
    bytes but the last one to three; its end steps are undone, the last bytes go in, and the end steps follow once more.
    Each step runs over the whole array, so no step needs its argument bound for a single term.
    """

    def begun(term: Column) -> Column:
        data, size = term.cast("binary"), F.octet_length(term)
        whole = size.bitwiseAND(F.lit(~3))
        word = F.conv(F.rpad(F.hex(F.substr(data, whole + 1, F.lit(3))), 6, "0"), 16, 10).cast("long")
        # The lengths before and after the last bytes meet in one number.
        return F.struct(
            F.hash(F.substr(data, F.lit(1), whole)).cast("long").bitwiseAND(F.lit(MASK)).alias("h"),
            word.alias("k"),
            whole.bitwiseXOR(size).cast("long").alias("n"),
        )

    def undone(x: Column) -> Column:
        lowest_first = F.shiftleft(x["k"].bitwiseAND(F.lit(0xFF)), 16) + x["k"].bitwiseAND(F.lit(0xFF00)) + F.shiftright(x["k"], 16)
        return F.struct(_times(_folded(x["h"], 16), END_INVERSES[1]).alias("h"), _times(lowest_first, K_FACTORS[0]).alias("k"), x["n"].alias("n"))

    def undone_first(x: Column) -> Column:
        h = _folded(x["h"], 13).bitwiseXOR(F.shiftright(x["h"], 26))
        return F.struct(_times(h, END_INVERSES[0]).alias("h"), _times(_turned(x["k"], 15), K_FACTORS[1]).alias("k"), x["n"].alias("n"))

    steps = (
        begun, undone, undone_first,
        lambda x: _folded(x["h"], 16).bitwiseXOR(x["k"]).bitwiseXOR(x["n"]),
        lambda h: _times(_folded(h, 16), END_FACTORS[0]),
        lambda h: _times(_folded(h, 13), END_FACTORS[1]),
        lambda h: _remainder(_folded(h, 16), buckets),
    )
    left_over = lambda t: F.octet_length(t).bitwiseAND(F.lit(3))

    def both(listed: Column) -> Column:
        whole = F.transform(F.filter(listed, lambda t: left_over(t) == 0), lambda t: F.pmod(F.hash(t), F.lit(buckets)))
        broken = F.filter(listed, lambda t: left_over(t) > 0)
        for step in steps:
            broken = F.transform(broken, step)
        return F.concat(whole, broken)

    return let(terms, both)
