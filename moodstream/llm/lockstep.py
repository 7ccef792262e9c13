"""Pair merging for many words at once: words of equal length advance together as one matrix."""

from __future__ import annotations

import heapq

import numpy as np

_NONE = np.iinfo(np.int64).max


class PairMerges:
    """Sorted table of mergeable pairs of ids with their rank (smaller merges first) and merged id."""

    def __init__(self, left, right, rank, merged):
        key = (np.asarray(left, np.int64) << 32) | np.asarray(right, np.int64)
        by = np.argsort(key)
        self.key, self.rank, self.merged = key[by], np.asarray(rank, np.int64)[by], np.asarray(merged, np.int64)[by]
        self._by_key: dict[int, tuple[int, int]] | None = None

    def merge_one(self, word: np.ndarray) -> np.ndarray:
        """The same for one long word: pairs wait in a heap, and every id knows its neighbours."""
        if self._by_key is None:
            self._by_key = dict(zip(self.key.tolist(), zip(self.rank.tolist(), self.merged.tolist())))
        pairs, ids = self._by_key, word.tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(*pairs[key], i, key) for i in range(n - 1) if (key := ids[i] << 32 | ids[i + 1]) in pairs]
        heap = [(rank, i, key, merged) for rank, merged, i, key in heap]
        heapq.heapify(heap)
        while heap:
            _, i, key, merged = heapq.heappop(heap)
            j = after[i]
            # An entry counts only while its two ids stand as they did.
            if ids[i] < 0 or j >= n or ids[i] << 32 | ids[j] != key:
                continue
            ids[i], ids[j] = merged, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (key := ids[a] << 32 | ids[b]) in pairs:
                    rank, merged = pairs[key]
                    heapq.heappush(heap, (rank, a, key, merged))
        return np.array([x for x in ids if x >= 0], np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.key):
            return np.full(left.shape, _NONE), np.zeros(left.shape, np.int64)
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return np.where(self.key[at] == wanted, self.rank[at], _NONE), self.merged[at]

    def merge(self, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merge the best pair of every row, leftmost on ties, until none is left.

        ``ids`` is a matrix of equally long words. Returns pairs of row numbers and their final ids.
        """
        done = []
        rows = np.arange(len(ids))
        ids = ids.astype(np.int64)
        rank, merged = self.find(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if ids.shape[1] == 1:
                done.append((rows, ids))
                break
            best = rank.argmin(axis=1)
            line = np.arange(len(rows))
            open_ = rank[line, best] < _NONE
            if not open_.all():
                done.append((rows[~open_], ids[~open_]))
                rows, ids, rank, merged, best = rows[open_], ids[open_], rank[open_], merged[open_], best[open_]
                line = np.arange(len(rows))
            if not len(rows):
                break
            n, size = ids.shape
            ids[line, best] = merged[line, best]
            keep = np.ones((n, size), bool)
            keep[line, best + 1] = False
            ids = ids[keep].reshape(n, size - 1)
            if size == 2:
                continue
            # The merged pair's own entry goes; its two neighbours are looked up again.
            keep = np.ones((n, size - 1), bool)
            keep[line, best] = False
            rank, merged = rank[keep].reshape(n, size - 2), merged[keep].reshape(n, size - 2)
            for at, rows_at in ((best - 1, best > 0), (best, best < size - 2)):
                i, p = line[rows_at], at[rows_at]
                rank[i, p], merged[i, p] = self.find(ids[i, p], ids[i, p + 1])
        return done


def by_length(words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Non-empty words as byte matrices, one for each length, with the positions of their words."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    out = []
    for size in np.unique(sizes[sizes > 0]):
        at = order[np.searchsorted(sizes[order], size) : np.searchsorted(sizes[order], size, "right")]
        joined = b"".join([words[i] for i in at])
        out.append((at, np.frombuffer(joined, np.uint8).reshape(-1, size)))
    return out
