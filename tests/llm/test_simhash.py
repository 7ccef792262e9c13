from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
import xxhash

from moodstream.llm import simhash
from moodstream.llm.simhash import fingerprints_of, keep_first, masks, near_links, op5, simhash_groups


@pytest.mark.parametrize("radius", [1, 2])
def test_masks_cover_every_pair(radius):
    for flips in range(radius + 1):
        for bits in combinations(range(64), flips):
            differing = sum(1 << b for b in bits)
            assert any(not differing & m for m in masks(radius))


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: id -> fingerprint; id -> least id of its component."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints():
    texts = ["a b c d a b c", "One two", "", "x", "ÀB c\x0bd\x0ce", "A\x1fB c d"]
    assert fingerprints_of([t.encode() for t in texts], 3, 42).tolist() == [brute_print(t) for t in texts]


def test_chains_and_clusters(llm):
    rng = np.random.default_rng(2)
    values = []
    for _ in range(30):
        x = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(int(rng.integers(1, 12))):
            values.append(x)
            for b in rng.integers(0, 64, int(rng.integers(0, 4))):
                x ^= 1 << int(b)
    values = sorted({v - 2**64 if v >> 63 else v for v in values})
    want = brute_components({v: v % 2**64 for v in values})
    links = near_links(llm.createDataFrame([(v,) for v in values], "f long")).collect()
    root = {v: v for v in values}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        assert ((a ^ b) % 2**64).bit_count() <= 2
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {v: find(v) for v in values} == want


def test_odd_rows(llm, odd_docs):
    rows = simhash_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    low = -(2**63)
    prints = {low if r["doc_id"] is None else r["doc_id"]: brute_print(r["text"]) for r in odd_docs.collect()}
    want = brute_components(prints)
    for r in rows:
        i = low if r.doc_id is None else r.doc_id
        assert r.fingerprint == f"{prints[i]:016x}"
        assert (low if r.component_id is None else r.component_id) == want[i]
    kept = keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == sorted({(v != low, v if v != low else 0) for v in want.values()})
    assert simhash_groups(odd_docs.limit(0)).count() == 0 == keep_first(odd_docs.limit(0)).count()


def test_registered_query(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = brute_components({r["doc_id"]: brute_print(r["text"]) for r in docs})
    assert {r.doc_id: r.component_id for r in op5(llm, "/root/testdata/sf0.001").collect()} == want


def near_values(seed=4, n=40):
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(n):
        x = int(rng.integers(0, 2**64, dtype=np.uint64))
        out.add(x)
        for _ in range(6):
            a, b = (int(v) for v in rng.integers(0, 64, 2))
            out.add(x ^ 1 << a ^ (1 << b if a != b else 0))
    return sorted(v - 2**64 if v >> 63 else v for v in out)


def close_pairs(values, radius):
    return {(a, b) for a in values for b in values if b < a and ((a ^ b) % 2**64).bit_count() <= radius}


@pytest.mark.parametrize("radius", [1, 2])
def test_buckets_give_every_close_pair(llm, radius):
    values = near_values()
    table = llm.createDataFrame([(v,) for v in values], "f long")
    assert {tuple(r) for r in near_links(table, radius).collect()} == close_pairs(values, radius)


@pytest.mark.parametrize("radius,largest", [(1, 1), (2, 1), (2, 3)])
def test_buckets_too_large_to_list_join_the_same_fingerprints(llm, radius, largest):
    values = near_values()
    links = {tuple(r) for r in near_links(llm.createDataFrame([(v,) for v in values], "f long"), radius, largest).collect()}
    want = close_pairs(values, radius)
    root = {True: {v: v for v in values}, False: {v: v for v in values}}
    for found, pairs in ((True, links), (False, want)):
        up = root[found]
        for a, b in sorted(pairs):
            low, high = sorted((up[a], up[b]))
            up.update({v: low for v, r in up.items() if r == high})
    assert root[True] == root[False]


def test_every_mask_is_needed(llm, monkeypatch):
    values = near_values(9, 400)
    table, want = llm.createDataFrame([(v,) for v in values], "f long"), close_pairs(values, 2)
    all_masks = simhash.masks(2)
    for left_out in range(0, len(all_masks), 3):
        monkeypatch.setattr(simhash, "masks", lambda radius, k=left_out: all_masks[:k] + all_masks[k + 1 :])
        assert {tuple(r) for r in near_links(table).collect()} < want
