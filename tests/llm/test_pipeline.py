"""The corpus pipeline, stage by stage, against brute-force versions of each stage on its own input."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from moodstream.llm import packing, quality
from tests.llm.test_suffix_dedup import brute as brute_repeats

FOLDER = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(packing.default_tokenizer())
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_scores(model, rows):
    """The factorisation machine's score of every row by its pairwise sum, in double precision."""
    out = {}
    for r in rows:
        index, value = quality.features(r["text"], r["n_chars"])
        value = value.astype(np.float64)
        factors = model.factors[index].astype(np.float64) * value[:, None]
        pairs = (factors @ factors.T)[np.triu_indices(len(index), 1)].sum()
        margin = model.bias + (model.weight[index] * value).sum() + pairs
        out[r["doc_id"], r["text"]] = 1 / (1 + np.exp(-margin))
    return out


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_first(rows):
    """Ids (with texts) that stay: the smallest of each component of fingerprints within two bits."""
    prints = [fingerprint(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append((r["doc_id"] is not None, r["doc_id"] or 0))
    return sorted(min(g) for g in groups.values())


def check_packed(packed, docs):
    pieces, places = defaultdict(dict), defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]][r["piece"]] = r
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for d in docs:
        ids = [*LIBRARY.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        own = pieces[d["doc_id"]]
        assert sorted(own) == list(range(-(-len(ids) // 4096)))
        for k, r in own.items():
            part = ids[4096 * k : 4096 * (k + 1)]
            assert (r["start"], r["length"], r["ids_crc32"]) == (4096 * k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 4096
    lengths = np.array([r["length"] for r in packed])
    return len(places), packing.sequence_bound(np.bincount(lengths, minlength=4097), 4096) if len(lengths) else 0


def run_stages(spark, folder):
    """Input and output rows of every stage, as the pipeline writes and reads them."""
    docs, steps = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.materialise(stage(spark, docs, folder), name)
        steps.append((docs.collect(), out.collect(), out.columns))
        docs = out
    return steps


def check_stages(llm, folder, model):
    (given, good, columns), (_, single, more), (_, cut, rest), (_, packed, _) = run_stages(llm, folder)
    assert columns == more == rest == COLUMNS
    scores = brute_scores(model, given)
    clear = [r for r in given if abs(scores[r["doc_id"], r["text"]] - 0.5) > 1e-4]
    assert sorted(map(str, (r for r in clear if scores[r["doc_id"], r["text"]] > 0.5))) == sorted(map(str, (r for r in good if r in clear)))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in single) == brute_first(good)
    assert all(r in good for r in single)
    want = brute_repeats([(r["doc_id"], r["text"]) for r in single])
    assert len(cut) == len(single)
    for r in cut:
        n, gone, _, _ = want[r["doc_id"]]
        assert r["n_chars"] == len(r["text"]) and (gone or len(r["text"].encode()) == n)
        if not gone:
            assert r["text"] in {x["text"] or "" for x in single if x["doc_id"] == r["doc_id"]}
        else:
            # A character that lost some of its bytes goes as a whole.
            assert n - gone - 6 * want[r["doc_id"]][2] <= len(r["text"].encode()) <= n - gone
    return given, good, single, cut, packed


def test_against_brute_force(llm):
    docs, labels = (llm.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    given, good, single, cut, packed = check_stages(llm, FOLDER, quality.train(docs, labels))
    sequences, bound = check_packed(packed, cut)
    assert bound <= sequences <= bound * 1.02 + 1
    # Every stage had something to do, and documents labelled good that are no copies are still there.
    assert len(given) > len(good) > len(single) and sum(r["n_chars"] for r in single) > sum(r["n_chars"] for r in cut)
    marked = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    assert len(marked & {r["doc_id"] for r in good}) >= 0.9 * len(marked & {r["doc_id"] for r in given})
    whole = corpus_pipeline.run(llm, FOLDER).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in whole) == sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed)


@pytest.mark.parametrize("empty", [False, True])
def test_odd_and_empty_tables(llm, odd_docs, tmp_path, empty):
    folder = str(tmp_path)
    rows = odd_docs.where("doc_id is null or doc_id <> 5").select(*COLUMNS)
    (rows.limit(0) if empty else rows).write.parquet(f"{folder}/documents.parquet")
    llm.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    if empty:
        assert [len(out) for _, out, _ in run_stages(llm, folder)] == [0, 0, 0, 0]
        return
    # Without labels the model is neutral: every row scores one half and stays.
    given, good, *_, cut, packed = check_stages(llm, folder, quality.train(rows, llm.read.parquet(f"{folder}/labels.parquet")))
    assert len(good) == len(given)
    check_packed(packed, cut)


def test_registered_packing(llm):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet").collect()
    packed = packing.op1(llm, FOLDER).collect()
    sequences, bound = check_packed(packed, docs)
    assert bound <= sequences <= bound * 1.02 + 1


def test_registered_scores(llm):
    docs, labels = (llm.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    want = {k[0]: v for k, v in brute_scores(model, docs.collect()).items()}
    rows = quality.op10(llm, FOLDER).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert abs(r["score"] - want[r["doc_id"]]) < 1e-4 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_what_is_learnt_does_not_depend_on_the_order_of_rows(llm):
    docs = llm.createDataFrame([(i % 7, f"word{i} other{i * 3}", 5) for i in range(60)], "doc_id long, text string, n_chars long")
    labels = llm.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    models = [quality.train(d, labels, sample=9, epochs=1) for d in (docs, docs.orderBy(F.desc("text")), docs.repartition(5))]
    assert all(np.array_equal(models[0].weight, m.weight) for m in models[1:])
