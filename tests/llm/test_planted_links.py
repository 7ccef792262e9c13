"""Links among planted vectors at the limit, in chains and in a large cluster, and the share of pairs the cells find."""

from __future__ import annotations

import numpy as np
import pytest

from moodstream.llm.lattice import CELL, PROBES, SEED, TABLES, cells, embedding_links
from tests.llm.test_vectors import brute_links
from collections import Counter


def at_cosine(rng, x, cosine):
    """Unit vectors at exactly this cosine to the rows of ``x``."""
    x = x / np.linalg.norm(x, axis=1)[:, None]
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    return cosine * x + np.sqrt(1 - cosine**2) * side


def planted(dim=64, seed=8):
    rng = np.random.default_rng(seed)
    vectors = [rng.normal(size=(1200, dim))]
    for cosine in (0.9299, 0.9301, 0.94, 0.97, 0.999):
        x = rng.normal(size=(80, dim))
        vectors += [x, 3 * at_cosine(rng, x, cosine)]
    step = rng.normal(size=(10, dim))
    for _ in range(8):  # chains whose ends do not link
        vectors.append(step)
        step = at_cosine(rng, step, 0.95)
    centre = np.repeat(rng.normal(size=(1, dim)), 300, axis=0)
    vectors.append(at_cosine(rng, centre, 0.975))  # some pairs link, some do not
    vectors.append(np.repeat(rng.normal(size=(1, dim)), 40, axis=0))
    rows = np.concatenate(vectors)
    order = rng.permutation(len(rows))
    # Both of a pair lie in one label nearly always; a few lie in another or in none.
    label = np.where(np.arange(len(rows)) % 50 == 0, 2, 1)
    return [(int(order[i]), rows[i].tolist(), None if i % 211 == 0 else int(label[i])) for i in range(len(rows))]


def test_more_than_two_thousand_vectors(llm):
    rows = planted()
    assert len(rows) > 2000
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(6)
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_links(df).collect())
    want = brute_links(rows)
    assert got == want
    assert max(r[1] for r in want) > 30 and sum(r[1] > 0 for r in want) > 700 and sum(not r[3] for r in want) > 500


@pytest.mark.parametrize("dim", [2, 3, 4, 5, 6, 7, 8, 16, 64, 384])
@pytest.mark.parametrize("cosine", [0.93, 0.95, 0.99])
def test_cells_find_close_pairs(dim, cosine):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(2000, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = at_cosine(rng, x, cosine)
    a, b = (cells(v, TABLES, PROBES, CELL, SEED).reshape(len(v), -1) for v in (x, y))
    met = (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)) if a.shape[1] < 100 else None
    assert met.mean() >= 0.999
