import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import nndescent

SCHEMA = "vec_id long, embedding array<float>"


def search(spark, df, ids, top=5):
    index = nndescent.build(df, top=top)
    got = nndescent.search(index, spark.createDataFrame([(i,) for i in ids], "vec_id long"), top).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def exact(rows, query, top=5):
    x = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    q = x[query]
    s = [(-(v @ q) / (math.sqrt(v @ v) * math.sqrt(q @ q)), i) for i, v in x.items() if i != query]
    return [(i, -s) for s, i in sorted(s)[:top]]


@pytest.mark.parametrize("clustered", [False, True])
def test_recall(spark, clustered):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32))
    if clustered:
        x = x * 0.2 + rng.normal(size=(12, 32))[rng.integers(0, 12, 3000)]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = search(spark, spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("own")), range(0, 3000, 50))
    hits = 0
    for q, found in got.items():
        want = exact(rows, q)
        hits += len({i for i, _ in want} & {i for _, i, _ in found})
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in found] == sorted((s for _, _, s in found), reverse=True)
    assert len(got) == 60 and hits >= 0.97 * 300


def test_hot_vector_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    hot = [1.0, 2.0, 3.0]
    rows = [(i, hot) for i in range(100, 700)] + [(i, [float(c) for c in rng.normal(size=3)]) for i in range(700, 900)]
    odd = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [1.0, math.nan, 2.0]),
           (6, [math.inf, 1.0, 1.0]), (7, [1.0, 2.0]), (None, hot), (8, [2.0, 4.0, 6.0]), (150, hot)]
    df = spark.createDataFrame(rows + odd, SCHEMA).repartition(4)
    got = search(spark, df, [100, 400, 650, 750, 8, 3, 7, 12345])
    valid = rows + [(8, [2.0, 4.0, 6.0])]
    assert set(got) == {100, 400, 650, 750, 8}
    for q, found in got.items():
        assert [i for _, i, _ in found] == [i for i, _ in exact(valid, q)]
        assert [s for _, _, s in found] == pytest.approx([s for _, s in exact(valid, q)], abs=1e-12)


def test_few_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], SCHEMA)
    got = search(spark, df, [1, 2])
    assert [i for _, i, _ in got[1]] == [3, 2] and [i for _, i, _ in got[2]] == [3, 1]
    assert search(spark, spark.createDataFrame([(1, [1.0])], SCHEMA), [1]) == {}
    assert search(spark, spark.createDataFrame([], SCHEMA), [1]) == {}


def test_effort_follows_the_data(spark, monkeypatch):
    # poor first lists and a narrow first beam: rounds and beam have to grow
    for name, value in (("ORDERS", 2), ("BLOCK", 16), ("FROM_ORDER", 4), ("BEAM", 8)):
        monkeypatch.setattr(nndescent, name, value)
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(3000, 32)))]
    got = search(spark, spark.createDataFrame(rows, SCHEMA), range(0, 3000, 50))
    hits = sum(len({i for i, _ in exact(rows, q)} & {i for _, i, _ in found}) for q, found in got.items())
    assert len(got) == 60 and hits >= 0.9 * 300, hits


def test_near_copies_and_scaled_copies(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=32) + 0.001 * rng.normal(size=(1500, 32))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    y = [float(c) for c in rng.normal(size=32).astype(np.float32)]
    scaled = [(2000 + k, [c * 2.0 ** (k % 40 - 20) for c in y]) for k in range(200)]
    got = search(spark, spark.createDataFrame(rows + scaled, SCHEMA), [*range(0, 1500, 50), 2100])
    hits = sum(len({i for i, _ in exact(rows, q)} & {i for _, i, _ in found})
               for q, found in got.items() if q < 2000)
    assert len(got) == 31 and hits >= 0.95 * 150, hits
    assert [i for _, i, _ in got[2100]] == [2000, 2001, 2002, 2003, 2004]


def test_adjacency_rows_are_small_and_whole(spark):
    # a list of 32 vectors of 256 bytes: batches of such rows filled the executors
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(200, 64)))]
    index = nndescent.build(spark.createDataFrame(rows, SCHEMA))
    stored = nndescent.adjacency(index).collect()
    assert max(len(r["vecs"]) for r in stored) <= 2048
    vec = {r["node"]: bytes(r["vec"]) for r in index.nodes.collect()}
    got = {}
    for r in stored:
        ids = np.frombuffer(r["ids"], "<i8").tolist()
        assert bytes(r["vecs"]) == b"".join(vec[i] for i in ids)
        got.setdefault(r["node"], []).extend(ids)
    assert {n: sorted(ids) for n, ids in got.items()} == {
        r["node"]: sorted(np.frombuffer(r["ids"], "<i8").tolist()) for r in index.lists.collect()}
