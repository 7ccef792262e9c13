"""Suffix arrays by induced sorting and permuted common prefixes, on numpy arrays.

Induction runs bucket by bucket: all suffixes that one bucket induces are placed by a few array
operations, and only a run of one repeated letter needs further rounds inside its own bucket. The
reduced string of the recursion is spelt in digits of at most ``_LETTERS`` values, which keeps the
number of buckets small at every level.
"""

from __future__ import annotations

import numpy as np

_LETTERS = 4096
_FEW_NAMES = 150_000


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Start positions of all suffixes of ``text`` (values from 0 to ``letters`` - 1) in sorted order."""
    if not len(text):
        return np.zeros(0, np.int64)
    closed = np.empty(len(text) + 1, np.int32)
    closed[:-1] = text
    closed[:-1] += 1
    closed[-1] = 0
    return _induced_sort(closed, letters + 1)[1:]


def _kinds(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the closing letter counts as smaller."""
    step = np.sign(np.diff(text))
    where = np.where(step != 0, np.arange(len(step)), len(step))
    decided = np.minimum.accumulate(where[::-1])[::-1]
    kinds = np.ones(len(text), bool)
    kinds[:-1] = np.append(step, -1)[decided] > 0
    return kinds


def _induced_sort(text: np.ndarray, letters: int) -> np.ndarray:
    n = len(text)
    if n <= 2:
        return np.arange(n - 1, -1, -1)
    smaller = _kinds(text)
    leftmost = np.zeros(n, bool)
    leftmost[1:] = smaller[1:] & ~smaller[:-1]
    seeds = np.flatnonzero(leftmost)
    order = _induce(text, letters, smaller, seeds)
    ordered = order[leftmost[order]]
    names, count = _name(text, seeds, ordered)
    if count < len(seeds):
        ordered = seeds[_sort_names(names, count, n)]
    return _induce(text, letters, smaller, ordered)


def _name(text: np.ndarray, seeds: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each leftmost-smaller substring, in text order, and the number of different ones."""
    following = np.append(seeds[1:], len(text) - 1)
    length = np.zeros(len(text), np.int64)
    length[seeds] = following - seeds + 1
    a, b = ordered[:-1], ordered[1:]
    differs = length[a] != length[b]
    live = np.flatnonzero(~differs)
    step = 0
    while len(live):
        left, right = a[live] + step, b[live] + step
        same = text[left] == text[right]
        differs[live[~same]] = True
        live = live[same]
        step += 1
        live = live[length[a[live]] > step]
    rank = np.zeros(len(text), np.int64)
    rank[ordered] = np.concatenate([[0], np.cumsum(differs)])
    return rank[seeds], int(differs.sum()) + 1


def _sort_names(names: np.ndarray, count: int, above: int) -> np.ndarray:
    """Order of the suffixes of the reduced string, whose last name is its unique smallest."""
    if len(names) > _FEW_NAMES and count <= _LETTERS:
        return _induced_sort(names.astype(np.int32), count)
    base = int(np.ceil(np.sqrt(count)))
    if len(names) > _FEW_NAMES and 2 * len(names) + 1 < 0.9 * above:
        spelt = np.empty(2 * len(names) + 1, np.int32)
        spelt[0:-1:2] = names // base + 1
        spelt[1:-1:2] = names % base + 1
        spelt[-1] = 0
        order = _induced_sort(spelt, base + 2)[1:]
        return order[order % 2 == 0] // 2
    # Few names, or hardly shorter than the level above: ranks of doubled prefixes end the recursion, as
    # buckets would then be too small for array operations.
    rank, width = names.copy(), 1
    while True:
        behind = np.full(len(rank), -1, np.int64)
        behind[:-width] = rank[width:]
        order = np.lexsort((behind, rank))
        fresh = (np.diff(rank[order]) != 0) | (np.diff(behind[order]) != 0)
        rank[order] = np.concatenate([[0], np.cumsum(fresh)])
        if rank[order[-1]] == len(rank) - 1:
            return order
        width = min(2 * width, len(rank) - 1)


def _induce(text: np.ndarray, letters: int, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Order of all suffixes from an order of the leftmost-smaller ones."""
    n = len(text)
    size = np.bincount(text, minlength=letters)
    end = np.cumsum(size)
    start = end - size
    order = np.full(n, -1, np.int32)
    letter_of_seed = text[seeds]
    by_letter = np.argsort(letter_of_seed, kind="stable")
    seeds = seeds[by_letter].astype(np.int32)
    seed_end = np.cumsum(np.bincount(letter_of_seed, minlength=letters))
    used = np.flatnonzero(size)

    def place(sources: np.ndarray, at: np.ndarray, want: bool, down: bool) -> None:
        before = sources[sources > 0] - 1
        before = before[smaller[before] == want]
        if not len(before):
            return
        letter = text[before]
        by = np.argsort(letter.astype(np.uint16), kind="stable")
        before, letter = before[by], letter[by]
        heads = np.flatnonzero(np.concatenate([[True], letter[1:] != letter[:-1]]))
        many = np.diff(np.append(heads, len(letter)))
        rank = np.arange(len(letter)) - np.repeat(heads, many)
        if down:
            order[at[letter] - 1 - rank] = before
            at[letter[heads]] -= many
        else:
            order[at[letter] + rank] = before
            at[letter[heads]] += many

    head = start.copy()
    for c in used:
        done = start[c]
        while done < head[c]:
            fresh = order[done : head[c]].copy()
            done = head[c]
            place(fresh, head, False, False)
        low = seed_end[c - 1] if c else 0
        if seed_end[c] > low:
            place(seeds[low : seed_end[c]], head, False, False)
    larger_end = head
    order[0] = n - 1
    tail = end.copy()
    for c in used[::-1]:
        done = end[c]
        while done > tail[c]:
            fresh = order[tail[c] : done][::-1].copy()
            done = tail[c]
            place(fresh, tail, True, True)
        if larger_end[c] > start[c]:
            place(order[start[c] : larger_end[c]][::-1].copy(), tail, True, True)
    return order.astype(np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Permuted common prefixes: for each position, the length it shares with its predecessor in ``order``.

    A prefix never runs over a letter equal to ``stop``. Only positions whose left letters differ are
    compared letter by letter; every other value is its left neighbour's less one. Returns the lengths by
    position and the predecessors.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    room = np.where(text == stop, np.arange(n), n)
    room = np.minimum.accumulate(room[::-1])[::-1] - np.arange(n)
    wide = np.zeros(n + 8, np.uint16)
    wide[:n] = text
    words = np.lib.stride_tricks.as_strided(wide.view(np.uint8), (n + 4, 8), (2, 1))
    linked = before >= 0
    repeats = np.zeros(n, bool)
    inner = np.flatnonzero(linked[1:]) + 1
    left = before[inner] - 1
    repeats[inner] = (left >= 0) & (text[inner - 1] == text[left]) & (text[inner - 1] != stop)
    heads = np.flatnonzero(~repeats)
    shared = np.zeros(len(heads), np.int64)
    most = np.where(before[heads] >= 0, np.minimum(room[heads], room[before[heads]]), 0)
    live = np.flatnonzero(most > 0)
    while len(live):
        a, b = heads[live] + shared[live], before[heads[live]] + shared[live]
        x = np.ascontiguousarray(words[a]).view(np.uint64).ravel() ^ np.ascontiguousarray(words[b]).view(np.uint64).ravel()
        got = np.where(x == 0, 4, 0)
        bit = x & (~x + np.uint64(1))
        got = np.where(x != 0, np.log2(np.maximum(bit, np.uint64(1)).astype(np.float64)).astype(np.int64) // 16, got)
        shared[live] += got
        live = live[(x == 0) & (shared[live] < most[live])]
    shared = np.minimum(shared, most)
    which = np.cumsum(~repeats) - 1
    return np.maximum(shared[which] - (np.arange(n) - heads[which]), 0), before
