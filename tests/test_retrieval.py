import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from perfkit.operators import embed as em
from perfkit.operators import evaluate as evl
from perfkit.operators import search as se


def brute(docs, queries, k):
    out = {}
    for qid, q in queries.items():
        sc = []
        for did, d in docs.items():
            den = np.sqrt(np.dot(q, q) * np.dot(d, d))
            s = round(float(np.dot(q, d) / den), 9) if den > 0 else 0.0
            sc.append((-s, did))
        out[qid] = [did for _, did in sorted(sc)[:k]]
    return out


@pytest.mark.parametrize("block", [64 << 20, 200])
def test_dense_topk_matches_brute_force(spark, block):
    rng = np.random.default_rng(7)
    docs = {i: rng.normal(size=6).astype(np.float32) for i in range(60)}
    docs[60] = docs[3].copy()          # exact duplicate: ties break by doc_id
    docs[61] = np.zeros(6, np.float32)  # zero vector scores 0
    queries = {100 + i: rng.normal(size=6) for i in range(12)}
    ddf = spark.createDataFrame([("v", i, v.tolist()) for i, v in docs.items()],
                                "version string, doc_id bigint, embedding array<float>").repartition(3)
    qdf = spark.createDataFrame([("v", i, v.tolist()) for i, v in queries.items()],
                                "version string, qid bigint, query_vec array<double>")
    hits = se.topk(ddf, qdf, k=4, dims={"v": 6}, max_block_bytes=block)
    got = {}
    for r in hits.orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["doc_id"])
    want = brute({i: v.astype(np.float64) for i, v in docs.items()}, queries, 4)
    assert got == want


def test_text_embedder_counts(spark):
    texts = {1: "the cat  sat\n on the mat", 2: "", 3: "a a a b"}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {(r["version"], r["doc_id"]): dict(zip(r["indices"], r["counts"]))
           for r in em.embed_text(df, {"x": 16, "y": 3}).collect()}
    for v, dim in {"x": 16, "y": 3}.items():
        for did, t in texts.items():
            toks = re.sub(r"\s+", " ", t).strip().split(" ")
            want = Counter(int(hashlib.md5(f"{v}::{tok}".encode()).hexdigest()[:8], 16) % dim for tok in toks)
            assert got[(v, did)] == dict(want)


def test_sparse_topk_and_evaluate(spark):
    docs = spark.createDataFrame([(1, "red apple pie"), (2, "green apple tart"), (3, "blue sky"),
                                  (4, "red apple pie")], "doc_id bigint, text string")
    golden = spark.createDataFrame([(10, "red apple", 1), (11, "blue sky today", 3), (12, "tart", 5)],
                                   "qid bigint, query string, expected_doc_id bigint")
    vs = {"v": 1024}
    d = em.embed_text(docs, vs)
    q = em.embed_text(golden, vs, id_col="qid", text_col="query").withColumnRenamed("doc_id", "qid")
    hits = se.topk(d, q, k=2, dims=vs)
    top = {r["qid"]: r["doc_id"] for r in hits.where("rank = 1").collect()}
    assert top[10] == 1 and top[11] == 3      # doc 1 and its copy 4 tie: lower id wins
    gv = golden.selectExpr("'v' as version", "qid", "expected_doc_id")
    e = evl.evaluate(hits, gv).first()
    assert e["n_queries"] == 3
    assert abs(e["top1_accuracy"] - 2 / 3) < 1e-12 and abs(e["mrr"] - 2 / 3) < 1e-12


def test_shadow_gate_rule(spark):
    ev = spark.createDataFrame([("b", 0.80, 0.80), ("ok", 0.78, 0.79), ("drop", 0.77, 0.9), ("low", 0.59, 0.99)],
                               "version string, top1_accuracy double, mrr double")
    pairs = spark.createDataFrame([("b", c) for c in ["ok", "drop", "low"]],
                                  "baseline_version string, candidate_version string")
    got = {r["candidate_version"]: r["pass"] for r in evl.shadow_compare(ev, pairs).collect()}
    assert got == {"ok": True, "drop": False, "low": False}
    strict = {r["candidate_version"]: r["pass"]
              for r in evl.shadow_compare(ev, pairs, min_score=0.99, allowed_drop=0.0).collect()}
    assert not any(strict.values())


def test_dense_projection_reads_every_dimension(spark):
    import hashlib

    import pytest

    from perfkit.operators import embed as em

    vecs = {1: [1.0, 2.0, 4.0, 8.0], 2: [0.0] * 4, 3: None}
    df = spark.createDataFrame(list(vecs.items()), "doc_id bigint, embedding array<float>")
    got = {(r["version"], r["doc_id"]): r["embedding"] for r in em.embed_dense(df, {"a": 4, "b": 3}, 4).collect()}
    sign = [[1 if hashlib.md5(f"b::{i}::{j}".encode()).hexdigest()[0] < "8" else -1 for i in (1, 2, 3, 4)]
            for j in (1, 2, 3)]
    assert got[("b", 1)] == [sum(x * s for x, s in zip(vecs[1], row)) for row in sign]
    assert got[("a", 1)] == vecs[1] and got[("b", 2)] == [0.0] * 3
    assert got[("a", 3)] is None and got[("b", 3)] is None
    with pytest.raises(Exception, match="vector width of id 1 is not 5"):
        em.embed_dense(df.where("doc_id = 1"), {"b": 3}, 5).collect()


def test_search_pairs_many_parts_and_blocks(spark):
    rng = np.random.default_rng(3)
    docs = {i: rng.integers(-2, 3, size=5).astype(np.float32) for i in range(80)}
    queries = {i: rng.integers(-2, 3, size=5).astype(np.float64) for i in range(40)}
    ddf = spark.createDataFrame([(v, i, x.tolist()) for v in "ab" for i, x in docs.items()],
                                "version string, doc_id bigint, embedding array<float>")
    qdf = spark.createDataFrame([("b", i, x.tolist()) for i, x in queries.items()],
                                "version string, qid bigint, query_vec array<double>")
    hits = se.topk(ddf, qdf, k=3, max_block_bytes=400).orderBy("qid", "rank").collect()
    got = {}
    for r in hits:
        got.setdefault(r["qid"], []).append(r["doc_id"])
    assert got == brute({i: x.astype(np.float64) for i, x in docs.items()}, queries, 3)
    assert {r["version"] for r in hits} == {"b"}


def test_search_errors(spark):
    docs = spark.createDataFrame([("v", 1, [1.0, 2.0]), ("v", 2, None)], "version string, doc_id bigint, embedding array<float>")
    ask = spark.createDataFrame([("v", 1, [1.0, 0.0])], "version string, qid bigint, query_vec array<double>")
    with pytest.raises(Exception, match="id 2: no vector, expected 2"):
        se.topk(docs, ask, dims={"v": 2}).collect()
    with pytest.raises(Exception, match="id 1: 2 dimensions, expected 3"):
        se.topk(docs.where("doc_id = 1"), ask, dims={"v": 3}).collect()
    with pytest.raises(ValueError, match="no documents or no width"):
        se.topk(docs.where("doc_id = 3"), ask)
    assert se.topk(docs.where("doc_id = 3"), ask, dims={"v": 2}).count() == 0
    with pytest.raises(RuntimeError, match="no golden queries"):
        se.topk(docs, ask.where("qid = 9"), dims={"v": 2})
    with pytest.raises(ValueError, match="over the block"):
        se.topk(docs, ask, dims={"v": 2}, max_block_bytes=8)


def test_text_embedder_on_long_texts_and_odd_blanks(spark, monkeypatch):
    monkeypatch.setattr(em, "SLICE", 40)
    monkeypatch.setattr(em, "HELD_TOKENS", 3)
    text = "  a\tb\x0bc d   e\r\nf  " * 50
    df = spark.createDataFrame([(1, text), (2, None), (3, " \n ")], "doc_id bigint, text string")
    got = {r["doc_id"]: dict(zip(r["indices"], r["counts"])) for r in em.embed_text(df, {"x": 16}).collect()}
    toks = re.sub("[ \t\n\x0b\f\r]+", " ", text).strip(" ").split(" ")
    place = lambda t: int(hashlib.md5(f"x::{t}".encode()).hexdigest()[:8], 16) % 16
    assert got == {1: dict(Counter(map(place, toks))), 3: {place(""): 1}}


def test_plug_in_models_are_made_once_per_worker_process(spark, tmp_path):
    log = str(tmp_path / "made")

    def factory(dim):
        def make():
            import os
            with open(log, "a") as f:
                f.write(f"{os.getpid()}:{dim}\n")
            return lambda texts: [[float(len(t))] * dim for t in texts]
        return make

    df = spark.createDataFrame([(i, "x" * i) for i in range(64)] + [(99, None)], "doc_id bigint, text string").repartition(16)
    out = em.embed_with(df, {"a": factory(2), "b": factory(3)})
    rows = out.collect() + out.collect()
    assert len(rows) == 2 * 2 * 65 and out.columns == ["version", "doc_id", "embedding"]
    assert all(r["embedding"] == [float(r["doc_id"] % 99)] * (2 if r["version"] == "a" else 3) for r in rows)
    made = open(log).read().split()
    assert len(made) == len(set(made)) and len(made) <= 2 * 4  # at most one worker per core of the test session
