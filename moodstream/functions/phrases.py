"""Removal of many phrases at once by a trie of tokens with failure links.

One scan over the tokens of a text finds every occurrence of every listed phrase, also those that overlap. A token costs
a few look-ups, whatever the number and the lengths of the phrases.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from moodstream.session import ship_package

#: The trie goes to every worker; a list that takes more is refused.
TRIE_BYTES = 64_000_000


class PhraseTrie:
    """Phrases of one or more words, told apart without regard to case.

    Node 0 is the root. ``step`` has each node's words with the nodes behind them, ``fallback`` the node of the longest
    proper ending that begins a phrase too, and ``longest`` the words of the longest phrase that ends at the node.
    """

    def __init__(self, phrases: Iterable[str]):
        self.step: list[dict[str, int]] = [{}]
        self.fallback = [0]
        self.longest = [0]
        for phrase in phrases:
            node, words = 0, phrase.lower().split()
            for word in words:
                if word not in self.step[node]:
                    self.step[node][word] = len(self.step)
                    self.step.append({})
                    self.fallback.append(0)
                    self.longest.append(0)
                node = self.step[node][word]
            if node:
                self.longest[node] = len(words)
        # Level by level: a node's fallback lies on a lower level, so it is settled already.
        level = list(self.step[0].values())
        while level:
            below = []
            for node in level:
                for word, child in self.step[node].items():
                    back = self.fallback[node]
                    while back and word not in self.step[back]:
                        back = self.fallback[back]
                    self.fallback[child] = self.step[back].get(word, 0)
                    self.longest[child] = max(self.longest[child], self.longest[self.fallback[child]])
                    below.append(child)
            level = below

    def ends(self, words: Sequence[str]) -> list[int]:
        """For each word, the length of the longest phrase that ends there, or 0."""
        step, fallback, longest = self.step, self.fallback, self.longest
        root, node, out = step[0], 0, []
        for word in words:
            while node and word not in step[node]:
                node = fallback[node]
            node = step[node].get(word, 0) if node else root.get(word, 0)
            out.append(longest[node])
        return out

    def kept(self, words: Sequence[str]) -> list[str] | None:
        """The words outside all occurrences, or None if there is no occurrence."""
        found = self.ends([w.lower() for w in words])
        if not any(found):
            return None
        out, covered = [], 0
        # From the end: an occurrence covers its last word and those before it.
        for word, length in zip(reversed(words), reversed(found)):
            covered = max(covered - 1, length)
            if not covered:
                out.append(word)
        return out[::-1]


def phrase_remover(spark: SparkSession, phrases: Iterable[str], limit: int = TRIE_BYTES) -> Callable[[Column], Column]:
    """A function of a token column that drops every token inside an occurrence of a listed phrase, ignoring case.

    The trie is sent to every worker once. One of more than ``limit`` bytes is refused, so what is sent does not grow
    with the data. Null token lists stay null; without phrases every token stays.
    """
    packed = pickle.dumps(PhraseTrie(phrases), protocol=5)
    if len(packed) > limit:
        raise ValueError(f"the phrases take {len(packed)} bytes, more than {limit}")
    ship_package(spark)
    sent = spark.sparkContext.broadcast(packed)

    @F.arrow_udf("array<string>")
    def remove(column: pa.Array) -> pa.Array:
        trie = _unpacked(sent)
        out = []
        for words in column.to_pylist():
            kept = None if words is None else trie.kept(words)
            out.append(words if kept is None else kept)
        return pa.array(out, pa.list_(pa.string()))

    return remove


_held: dict[int, PhraseTrie] = {}


def _unpacked(sent) -> PhraseTrie:
    """The broadcast trie, unpacked once per worker: hashing its bytes is remembered by them."""
    key = hash(sent.value)
    if key not in _held:
        _held.clear()
        _held[key] = pickle.loads(sent.value)
    return _held[key]
