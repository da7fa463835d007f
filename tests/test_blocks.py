"""Exact search over blocks, and product-quantised search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import blocks as B
from corpusflow.operators import quantised as Q


def table(spark, x, id_type="long", first=0):
    rows = [(str(i) if id_type == "string" else i, v.tolist()) for i, v in enumerate(x, first)]
    return spark.createDataFrame(rows, f"c_id {id_type}, vector array<float>").repartition(3)


def asked(spark, q):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "q_id long, vector array<float>")


def brute(x, q, k, ids):
    x, q = x.astype(np.float32).astype(np.float64), q.astype(np.float32).astype(np.float64)
    out = {}
    for i, v in enumerate(q):
        d = np.sqrt(((x - v) ** 2).sum(axis=1))
        best = sorted(zip(d.tolist(), ids))[:k]
        out[i] = [(c, round(a, 9)) for a, c in best]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["q_id"], r["rank"])):
        out.setdefault(r["q_id"], []).append((r["c_id"], round(r["distance"], 9)))
    return out


def bags(rng, n, dim=48, kinds=6):
    """Normalised counts around a few topics, with copies and empty rows."""
    topics = rng.dirichlet(np.full(dim, 0.15), size=kinds)
    x = np.array([rng.multinomial(40, topics[rng.integers(kinds)]) for _ in range(n)], dtype=float)
    x[rng.integers(n, size=n // 10)] = x[0]
    x[rng.integers(n, size=3)] = 0
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


@pytest.mark.parametrize("form", ["lists", "pivots"])
@pytest.mark.parametrize("kind", ["bags", "normal", "copies", "far"])
def test_equals_comparing_everything(spark, form, kind):
    rng = np.random.default_rng(4)
    x = {"bags": lambda: bags(rng, 1800), "normal": lambda: rng.normal(size=(700, 10)),
         "copies": lambda: np.repeat(rng.normal(size=(3, 6)), 400, axis=0),
         "far": lambda: rng.normal(size=(900, 8)) * 1e-3 + rng.integers(0, 5, size=(900, 1)) * 100.0}[kind]()
    q = np.concatenate([x[::150], x[:4] + 0.01, np.zeros((1, x.shape[1]))])
    id_type = "string" if kind == "bags" else "long"
    ids = [str(i) if id_type == "string" else i for i in range(len(x))]
    index = B.build(table(spark, x, id_type), form)
    hits, work = B.topk(asked(spark, q), index, 5)
    got, want = found(hits), brute(x, q, 5, ids)
    assert got == want
    read, held = work.agg(F.sum("read"), F.sum("held")).first()
    assert 0 < read <= held
    if kind == "far":
        assert read < 0.5 * held                    # other groups are never read
    again, _ = B.topk(asked(spark, q), index, 5, max_broadcast_bytes=200)      # several blocks of questions
    assert found(again) == want


@pytest.mark.parametrize("form", ["lists", "pivots"])
def test_small_and_empty_tables(spark, form):
    q = np.array([[1.0, 0.0], [0.0, 0.0]])
    index = B.build(table(spark, np.array([[0.0, 1.0], [1.0, 0.0]])), form)
    assert {i: [c for c, _ in v] for i, v in found(B.topk(asked(spark, q), index, 5)[0]).items()} == {0: [1, 0], 1: [0, 1]}
    assert B.topk(asked(spark, q).limit(0), index, 5)[0].count() == 0
    nothing = B.build(table(spark, np.array([[0.0, 1.0]])).limit(0), form)
    assert B.topk(asked(spark, q), nothing, 5)[0].count() == 0


def test_quantised_search_recall(spark):
    rng = np.random.default_rng(9)
    for n in (400, 3000):
        x, q = rng.normal(size=(n, 16)), rng.normal(size=(60, 16))
        hits, length = Q.topk(asked(spark, q), Q.build(table(spark, x)), 5)
        want, got = brute(x, q, 5, list(range(n))), found(hits)
        recall = np.mean([len(set(got[i]) & set(want[i])) / 5 for i in want])
        assert recall >= 0.9 and 5 <= length < n / 2
    assert Q.topk(asked(spark, q).limit(0), Q.build(table(spark, x)), 5)[0].count() == 0
    assert Q.topk(asked(spark, q), Q.build(table(spark, x).limit(0)), 5)[0].count() == 0
    whole, _ = Q.topk(asked(spark, q), Q.build(table(spark, x)), 5, length=n)       # a shortlist of all rows is exact
    assert found(whole) == want
