"""Chunking, embedding, exact and approximate search, citations."""

import json
import re

import numpy as np
from pyspark.sql import functions as F

from corpusflow.config import ChunkConfig
from corpusflow.operators import knowledge as K


def test_chunk_windows(spark):
    cfg = ChunkConfig(size=5, overlap=2, dim=8)
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(11))), (2, "a b"), (3, "   ")],
                                 "doc_id long, text string")
    ch = {(r.doc_id, r.pos): r.text for r in K.chunk_documents(docs, cfg).collect()}
    assert ch == {(1, 0): "w0 w1 w2 w3 w4", (1, 1): "w3 w4 w5 w6 w7", (1, 2): "w6 w7 w8 w9 w10",
                  (2, 0): "a b"}


def test_embedding_is_normalised_bag(spark):
    df = spark.createDataFrame([(1, "Alpha beta, beta! GAMMA"), (2, "")], "id long, text string")
    v = {r.id: np.array(r.vector) for r in K.embed(df, "text", 16).collect()}
    assert abs(np.linalg.norm(v[1]) - 1) < 1e-6 and np.count_nonzero(v[2]) == 0
    import hashlib
    b = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 16 for t in ["alpha", "beta", "beta", "gamma"]]
    exp = np.bincount(b, minlength=16).astype(float)
    assert np.allclose(v[1], exp / np.linalg.norm(exp), atol=1e-6)


def test_a_text_is_split_once(spark):
    """A filter on the words was pushed down as a second split of every text."""
    docs = spark.createDataFrame([(1, "a b"), (2, " \t\u3000"), (3, None), (4, ""), (5, "\u00a0x")], "doc_id long, text string")
    chunks = K.chunk_documents(docs, ChunkConfig(size=5, overlap=2, dim=8))
    assert sorted((r.doc_id, r.text) for r in chunks.collect()) == [(1, "a b"), (5, "x")]
    plan = chunks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1


def test_only_tokens_reach_python_in_bounded_slices(spark, monkeypatch):
    texts = ["a b c", "", "--", None, " ".join(f"w{i}" for i in range(40)), "B a", "\u00e9t\u00e9 b"] * 3
    df = spark.createDataFrame([(i, t, "x" * 50) for i, t in enumerate(texts)], "id long, text string, other string").coalesce(1)
    whole = {r.id: tuple(r.vector) for r in K.embed(df, "text", 16).collect()}
    monkeypatch.setattr(K, "SLICE_TOKENS", 5)
    monkeypatch.setattr(K, "MEMO_LIMIT", 3)
    out = K.embed(df, "text", 16)
    assert {r.id: tuple(r.vector) for r in out.collect()} == whole and len(whole) == len(texts)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan        # whole rows went through Python
    for i, t in enumerate(texts):
        want = np.zeros(16)
        for w in filter(None, re.split(r"[^a-z0-9\u00e9]+", (t or "").lower())):
            want[K.token_bucket(w, 16)] += 1
        assert np.allclose(whole[i], want / (np.linalg.norm(want) or 1.0), atol=1e-6)


def _brute(q, c, k):
    out = {}
    for qi, qv in q.items():
        d = sorted((float(np.sqrt(((np.array(cv, float) - np.array(qv, float)) ** 2).sum())), ci) for ci, cv in c.items())
        out[qi] = [ci for _, ci in d[:k]]
    return out


def test_exact_topk_and_batching(spark):
    rng = np.random.default_rng(3)
    c = {i: rng.normal(size=8).astype(np.float32).tolist() for i in range(300)}
    c[300] = c[5]  # exact duplicate: tie broken by id
    q = {i: rng.normal(size=8).astype(np.float32).tolist() for i in range(12)}
    q[99] = c[5]
    cdf = spark.createDataFrame(list(c.items()), "c_id long, vector array<float>").repartition(4)
    qdf = spark.createDataFrame(list(q.items()), "q_id long, vector array<float>")
    exp = _brute(q, c, 5)
    for limit in (1 << 20, 200):  # the second forces several broadcast batches
        hits = K.vector_topk(qdf, cdf, 5, max_broadcast_bytes=limit).collect()
        got = {}
        for h in sorted(hits, key=lambda r: (r.q_id, r.rank)):
            got.setdefault(h.q_id, []).append(h.c_id)
        assert got == exp
    assert exp[99][:2] == [5, 300]


def test_ann_recall(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(8, 16)) * 4
    c = {i: (centers[i % 8] + rng.normal(size=16)).astype(np.float32).tolist() for i in range(800)}
    q = {i: (centers[i % 8] + rng.normal(size=16)).astype(np.float32).tolist() for i in range(40)}
    cdf = spark.createDataFrame(list(c.items()), "c_id long, vector array<float>")
    qdf = spark.createDataFrame(list(q.items()), "q_id long, vector array<float>")
    exp = _brute(q, c, 5)
    hits = K.vector_topk_ann(qdf, cdf, 5, n_lists=8, n_probe=2).collect()
    got = {}
    for h in hits:
        got.setdefault(h.q_id, set()).add(h.c_id)
    recall = np.mean([len(got.get(i, set()) & set(exp[i])) / 5 for i in q])
    assert recall >= 0.9, recall


def test_ann_recall_of_defaults_on_unclustered_vectors(spark):
    rng = np.random.default_rng(8)
    c = {i: v.tolist() for i, v in enumerate(rng.normal(size=(2000, 32)).astype(np.float32))}
    q = {i: v.tolist() for i, v in enumerate(rng.normal(size=(300, 32)).astype(np.float32))}
    hits = K.vector_topk_ann(spark.createDataFrame(list(q.items()), "q_id long, vector array<float>"),
                             spark.createDataFrame(list(c.items()), "c_id long, vector array<float>"), 5).collect()
    exp, got = _brute(q, c, 5), {}
    for h in hits:
        got.setdefault(h.q_id, set()).add(h.c_id)
    recall = np.mean([len(got.get(i, set()) & set(exp[i])) / 5 for i in q])
    assert recall >= 0.9, recall


def test_citation_value_forms(spark):
    refs = [("s3://b/1", json.dumps({"source_url": "https://w/1", "title": "T1"})),
            ("s3://b/2", json.dumps({"source_url": {"stringValue": "https://w/2", "type": "STRING"},
                                     "title": {"value": "T2"}})),
            ("s3://b/3", json.dumps({"source_url": {"value": "https://w/1"}, "title": "other title"})),
            ("s3://b/4", json.dumps({"source_url": {}})),
            ("s3://b/5", json.dumps({}))]
    resp = spark.createDataFrame(
        [(1, [{"refs": [{"uri": u, "metadata": m} for u, m in refs[:2]]},
              {"refs": [{"uri": u, "metadata": m} for u, m in refs[2:]]}, {"refs": []}])],
        "q_id long, citations array<struct<refs: array<struct<uri: string, metadata: string>>>>")
    flat = K.citation_flatten(resp).orderBy("citation_no", "ref_no").collect()
    assert [r.display for r in flat] == ["https://w/1", "https://w/2", "https://w/1", "s3://b/4", "s3://b/5"]
    assert [r.title for r in flat] == ["T1", "T2", "other title", "", ""]
    d = K.citation_dedupe(K.citation_flatten(resp)).orderBy("source_no").collect()
    assert [(r.display, r.title) for r in d] == [("https://w/1", "T1"), ("https://w/2", "T2"),
                                                 ("s3://b/4", ""), ("s3://b/5", "")]
    g = K.answer_grounding(resp, K.citation_flatten(resp)).first()
    assert (g.n_citations, g.n_refs, g.n_sources) == (3, 5, 4)


def test_title_flag_changes_embedded_text(spark):
    from corpusflow.config import ChunkConfig as CC
    from corpusflow.plans.knowledge import kb_chunks
    from conftest import SF_SMALL
    plain = {r.chunk_id: r.vector for r in kb_chunks(spark, SF_SMALL, CC(size=50, overlap=10, dim=16)).collect()}
    titled = {r.chunk_id: r.vector for r in
              kb_chunks(spark, SF_SMALL, CC(size=50, overlap=10, dim=16, include_title=True)).collect()}
    assert plain.keys() == titled.keys()
    assert sum(plain[k] != titled[k] for k in plain) > 0   # attributes flagged for embedding enter the text


def test_embedder_argument_and_blocks(spark):
    """An embedder of the caller's, and question blocks of a few rows."""
    def lengths(texts, dim):
        return [[float(len(t))] + [1.0] * (dim - 1) for t in texts]
    df = spark.createDataFrame([(i, "x" * i) for i in range(40)] + [(99, None)], "id long, text string")
    v = K.embed(df, "text", 3, embedder=lengths)
    assert {r.id: list(r.vector) for r in v.collect()}[7] == [7.0, 1.0, 1.0]
    q = v.select(F.col("id").alias("q_id"), "vector")
    c = v.select(F.col("id").alias("c_id"), "vector")
    whole = K.vector_topk(q, c, 3).orderBy("q_id", "rank").collect()
    assert K.vector_topk(q, c, 3, max_broadcast_bytes=200).orderBy("q_id", "rank").collect() == whole
    assert K.vector_topk(q.limit(0), c, 3).count() == K.vector_topk_ann(q.limit(0), c, 3, n_lists=2).count() == 0
    near = K.vector_topk_ann(q, c, 3, n_lists=4, n_probe=4, max_broadcast_bytes=200)
    assert near.orderBy("q_id", "rank").collect() == whole
