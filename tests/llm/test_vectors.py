from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import combinations

import numpy as np
import pytest

from moodstream.llm.lattice import cells, embedding_links, nearest_e8, op9
from moodstream.llm import nearest as near_module
from moodstream.llm.nearest import block_best, nearest, op8

NAN = float("nan")


def clean(rows):
    return [(i, np.array(v, float), l) for i, v, l in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]


@pytest.fixture(scope="module")
def odd_vectors(llm):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(6, 16))
    rows = [(i, [float(x) for x in base[i % 6] + 0.08 * rng.normal(size=16)], i % 2) for i in range(40)]
    rows += [(100 + i, rows[0][1], 0) for i in range(5)] + [rows[3], rows[3]]
    rows += [(200, None, 0), (201, [], 0), (202, [0.0] * 16, 0), (203, [NAN] + [1.0] * 15, 1), (204, [None] + [1.0] * 15, 1), (205, rows[2][1], None)]
    rows += [(206, [1.0, 2.0], 0), (220, [1.0, 2.0], 0), (None, rows[4][1], 0), (240, [float("inf")] * 16, 1)]
    return rows, llm.createDataFrame([(*r, "x", 1.5) for r in rows], "vec_id long, embedding array<double>, label int, score string, r double")


def test_blocks_are_exact():
    rng = np.random.default_rng(0)
    q, c = rng.normal(size=(7, 24)), rng.normal(size=(300, 24))
    c[10:20] = c[0]
    qi, ci = np.arange(7), np.arange(300)
    row, col, score = block_best(qi, q, ci, c, 20)
    for i in range(7):
        exact = [(reduce(lambda s, k: s + q[i, k] * c[j, k], range(24), 0.0), j) for j in range(300) if j != i]
        want = sorted(exact, key=lambda x: (-x[0], x[1]))[:20]
        assert [(s, j) for s, j in zip(score[row == i], col[row == i])] == want


def brute_nearest(rows, step, best):
    good = [(i, v) for i, v, _ in clean(rows) if i is not None]
    out = set()
    for i, v in {i: v for i, v in reversed(good) if i % step == 0}.items():
        near = sorted((-float((v * w).sum()), j) for j, w in good if j != i and len(w) == len(v))[:best]
        out |= {(i, k + 1, j, round(-s, 9)) for k, (s, j) in enumerate(near)}
    return out


def test_nearest_odd_rows(llm, odd_vectors):
    rows, df = odd_vectors
    got = nearest(df.where("vec_id % 20 = 0"), df, best=7).collect()
    assert {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got} == brute_nearest(rows, 20, 7)
    assert nearest(df.limit(0), df).count() == 0 == nearest(df, df.limit(0)).count()


def test_nearest_over_many_small_blocks(llm, odd_vectors, monkeypatch):
    rows, df = odd_vectors
    for name, value in (("QUERY_ROWS", 2), ("CANDIDATE_ROWS", 3), ("FAN", 2)):
        monkeypatch.setattr(near_module, name, value)
    got = nearest(df.where("vec_id % 20 = 0"), df.repartition(3), best=7).collect()
    assert {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got} == brute_nearest(rows, 20, 7)


def test_nearest_registered_query(llm):
    rows = [(r.vec_id, r.embedding, r.label) for r in llm.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = op8(llm, "/root/testdata/sf0.001").collect()
    assert {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got} == brute_nearest(rows, 20, 20)


def test_e8_points():
    x = np.random.default_rng(3).normal(size=(200, 8)) * 2
    p = nearest_e8(x)
    assert ((p % 2 == p[:, :1] % 2).all()) and (p.sum(axis=1) % 4 == 0).all()
    # No farther than the covering radius, and no shortest step leads nearer.
    from moodstream.llm.lattice import _shortest

    far = ((x - p / 2) ** 2).sum(axis=1)
    assert (far <= 1 + 1e-9).all() and len(_shortest()) == 240
    for step in _shortest():
        assert (((x - (p + step) / 2) ** 2).sum(axis=1) >= far - 1e-9).all()


def test_own_cell_comes_first_and_near_vectors_meet():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 64))
    y = x + 0.22 * rng.normal(size=x.shape)
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in (x, y))
    a, b = (cells(v, 16, 4, 0.45, 11).reshape(400, -1) for v in (x, y))
    close = (x * y).sum(axis=1) >= 0.93
    met = np.array([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)])
    assert close.sum() > 300 and met[close].mean() > 0.95


def brute_links(rows, least=0.93):
    good = [(k, i, v / np.linalg.norm(v), l) for k, (i, v, l) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v) and l is not None for v in [np.array(v, float)]]
    links, root = Counter(), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for (k, _, v, a), (m, _, w, b) in combinations(good, 2):
        if a == b and len(v) == len(w) and v @ w >= least:
            links[k] += 1
            links[m] += 1
            root[find(k)] = find(m)
    low = -(2**63)
    names = [low if i is None else i for i, _, _ in rows]
    least_of = {}
    for k in range(len(rows)):
        least_of[find(k)] = min(least_of.get(find(k), names[k]), names[k])
    return Counter((names[k], links[k], least_of[find(k)], names[k] == least_of[find(k)]) for k in range(len(rows)))


@pytest.mark.parametrize("tile", [512, 4])
def test_links_odd_rows(llm, odd_vectors, tile):
    rows, df = odd_vectors
    low = -(2**63)
    got = Counter((low if r.vec_id is None else r.vec_id, r.n_links, low if r.component_id is None else r.component_id, r.kept) for r in embedding_links(df, tile=tile).collect())
    assert got == brute_links(rows)
    assert embedding_links(df.limit(0)).count() == 0


def test_links_registered_query(llm):
    rows = [(r.vec_id, r.embedding, r.label) for r in llm.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in op9(llm, "/root/testdata/sf0.01").collect())
    assert got == brute_links(rows)
