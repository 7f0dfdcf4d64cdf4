"""The pass in single precision changes no result, and leaves most pairs out of double precision."""

import numpy as np
import pyarrow as pa
import pytest

from perfkit.operators import search as se


def tables(docs, queries):
    def of(x, name, vec):
        return pa.table({"version": ["v"] * len(x), name: pa.array(range(len(x)), pa.int64()), vec: pa.array(list(x), pa.list_(pa.float64()))})
    return of(docs, "doc_id", "embedding"), of(queries, "qid", "query_vec")


def brute(docs, queries, k):
    out = []
    for qid, q in enumerate(queries):
        den = np.sqrt((q * q).sum() * (docs * docs).sum(axis=1))
        s = np.round(np.divide(docs @ q, den, out=np.zeros(len(docs)), where=den > 0), se.ROUND)
        out += [(qid, int(i), s[i]) for i in np.lexsort((np.arange(len(docs)), -s))[:k]]
    return out


@pytest.mark.parametrize("kind", ["random", "copies", "close", "zeros", "tiny", "few"])
def test_equal_to_scoring_every_pair(kind, monkeypatch):
    rng = np.random.default_rng(5)
    docs = rng.integers(0, 4, (3 if kind == "few" else 3000, 40)).astype(float)
    if kind == "copies":
        docs[500:2500] = docs[7]
    if kind == "close":  # cosines that single precision can't tell apart
        docs[:] = 1000
        docs[np.arange(3000), rng.integers(0, 40, 3000)] += rng.integers(0, 3, 3000) * 1e-2
    if kind == "zeros":
        docs[::2] = 0
    queries = docs[rng.integers(0, len(docs), 50)] + (rng.integers(0, 2, (50, 40)) if kind != "copies" else 0)
    if kind == "tiny":
        docs[::3] *= 1e-160
    monkeypatch.setattr(se, "TILE_CELLS", 1 << 14)
    d, q = tables(docs, queries)
    got = se._pair_kernel(5, {"v": 40})(d, q)
    got = sorted(zip(got["qid"].to_pylist(), got["score"].to_pylist(), got["doc_id"].to_pylist()), key=lambda r: (r[0], -r[1], r[2]))
    want = brute(docs, queries, 5)
    assert [(a, c) for a, _, c in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([b for _, b, _ in got], [s for _, _, s in want], rtol=0, atol=2e-9)


def test_few_pairs_are_scored_in_double_precision(monkeypatch):
    rng = np.random.default_rng(6)
    docs, queries = rng.normal(size=(20_000, 64)), rng.normal(size=(100, 64))
    scored, plain = [], se._scores
    monkeypatch.setattr(se, "_scores", lambda dots, squares: scored.append(dots.size) or plain(dots, squares))
    d, q = tables(docs, queries)
    se._pair_kernel(5, {"v": 64})(d, q)
    assert sum(scored) < 0.01 * len(docs) * len(queries)
