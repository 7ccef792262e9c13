from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from moodstream.llm.hilbert import curve_index, op7, shard_by_curve, write_shards


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(product(range(1 << bits), repeat=dims)))
    at = curve_index(cells, bits)
    assert sorted(at.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def check(rows, docs, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(docs)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def test_registered_query(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    rows = op7(llm, "/root/testdata/sf0.01").collect()
    check(rows, docs, 24)
    by_shard = defaultdict(set)
    lang = {r["doc_id"]: r["lang"] for r in docs}
    for r in rows:
        by_shard[r.shard].add(lang[r.doc_id])
    assert np.mean([len(v) for v in by_shard.values()]) < 2.5


@pytest.mark.parametrize("shards", [3, 24])
def test_odd_rows(llm, odd_docs, shards):
    check(shard_by_curve(odd_docs, shards=shards).collect(), odd_docs.collect(), shards)
    assert shard_by_curve(odd_docs.limit(0)).count() == 0


def test_written_shards(llm, odd_docs, tmp_path):
    write_shards(odd_docs, str(tmp_path / "out"), shards=4)
    back = llm.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd_docs.count() and set(back.columns) == {*odd_docs.columns, "shard", "slot"}
