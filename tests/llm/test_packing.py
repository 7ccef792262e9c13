from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from moodstream.llm.packing import ChunkTokens, best_fit, default_tokenizer, pack, pack_documents, sequence_bound

PATH = default_tokenizer()
TOKENS = ChunkTokens(PATH)
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aB'sdtl1 !.é́<|endoftext|>\x1f", max_size=40))
def test_ids_are_the_library_s(text):
    assert np.frombuffer(TOKENS.ids([text])[0], "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=60))
def test_best_fit_and_its_bound(lengths):
    sizes = np.array(lengths)
    bins, offsets, fill = best_fit(sizes, 60)
    bound = sequence_bound(np.bincount(sizes, minlength=61), 60)
    assert bound <= len(fill) and fill.max() <= 60
    for b in range(len(fill)):
        at = sorted((offsets[i], sizes[i]) for i in np.flatnonzero(bins == b))
        assert [o for o, _ in at] == [sum(s for _, s in at[:k]) for k in range(len(at))]


def test_bound_beats_the_plain_sum():
    assert sequence_bound(np.bincount([31] * 10, minlength=61), 60) == 10
    assert sequence_bound(np.bincount([21] * 9, minlength=61), 60) == 5


def check(rows, lengths, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for placed in by.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:k]) for k in range(len(placed))]
        assert sum(n for _, n in placed) <= capacity
    assert sorted(r.length for r in rows) == sorted(lengths)
    return len(by)


def test_partitions_exchange_documents(llm):
    lengths = [int(x) for x in np.random.default_rng(5).integers(1, 41, 400)]
    pieces = llm.createDataFrame([(i, 0, n, 0) for i, n in enumerate(lengths)], "id long, piece int, length long, ids_crc32 long")
    alone = check(pack(pieces, 100, per_partition=20, rounds=1).collect(), lengths, 100)
    joined = check(pack(pieces, 100, per_partition=20).collect(), lengths, 100)
    assert joined < alone
    assert joined <= sequence_bound(np.bincount(lengths, minlength=101), 100) * 1.03 + 1


def test_odd_rows(llm, odd_docs):
    rows = pack_documents(odd_docs, PATH, with_ids=True).collect()
    want = defaultdict(list)
    for r in odd_docs.collect():
        ids = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want[r["doc_id"]] += [(i // 4096, i, len(ids[i : i + 4096]), zlib.crc32(np.array(ids[i : i + 4096], "<u4").tobytes())) for i in range(0, len(ids), 4096)]
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    check(rows, [n for v in want.values() for _, _, n, _ in v], 4096)
    assert pack_documents(odd_docs.limit(0), PATH).count() == 0
