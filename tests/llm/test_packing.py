import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from corpusflow.llm import packing
from corpusflow.llm.packing import Capacity


def one_by_one(lengths, cap, weights, by):
    """Best-fit decreasing, item by item; residual vectors of all sequences."""
    c = cap.vector()
    bins = []
    for n in sorted(lengths, reverse=True):
        need = packing.demand(n)
        if (need > c).any():
            continue
        fits = [i for i, r in enumerate(bins) if (r >= need).all()]
        if fits:
            r = np.array([bins[i] for i in fits])
            if by == "dot":
                s = -((r / c) * (need / c) * np.array(weights)).sum(axis=1)
            else:
                s = ((((r - need) / c) ** 2) * np.array(weights)).sum(axis=1)
            i = fits[int(np.argmin(s))]
        else:
            bins.append(c.copy())
            i = len(bins) - 1
        bins[i] = bins[i] - need
    return bins


def test_plan_equals_placing_one_by_one():
    rng = random.Random(4)
    for cap in (Capacity(64, 1000, 64 * 64), Capacity(64, 3, 64 * 64), Capacity(64, 1000, 700)):
        for _ in range(20):
            lengths = [rng.choice([rng.randint(1, 64), rng.randint(1, 9), 17]) for _ in range(rng.randint(1, 120))]
            plan = packing.plan(Counter(lengths), cap)
            want = one_by_one(lengths, cap, (1.0, 0.01, 0.01), "norm")
            have = Counter()
            for r, n in zip(plan.residual.tolist(), plan.count.tolist(), strict=True):
                have[tuple(r)] += n
            assert +have == Counter(tuple(r.tolist()) for r in want)


def test_dot_plan_equals_placing_one_by_one():
    rng = random.Random(9)
    cap = Capacity(64, 1000, 64 * 64)
    for _ in range(30):
        lengths = [rng.choice([rng.randint(1, 64), rng.randint(1, 9), 17]) for _ in range(rng.randint(1, 120))]
        plan = packing.plan(Counter(lengths), cap, by="dot")
        have = Counter()
        for r, n in zip(plan.residual.tolist(), plan.count.tolist(), strict=True):
            have[tuple(r)] += n
        assert +have == Counter(tuple(r.tolist()) for r in one_by_one(lengths, cap, (1.0, 0.01, 0.01), "dot"))


def check(rows, cap):
    seqs = {}
    for r in rows:
        if r["sequence_id"] is not None:
            seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"] or 0))
    for items in seqs.values():
        items.sort()
        at = 0
        for offset, length in items:
            assert offset == at
            at += length
        assert at <= cap.tokens and len(items) <= cap.documents
        assert sum(n * n for _, n in items) <= cap.attention
    return len(seqs)


def test_pack(spark):
    rng = random.Random(1)
    rows = [(i, 33 if i % 3 == 0 else rng.randint(1, 100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, length long").repartition(7).withColumn("offset", F.lit("own"))
    for by in ("norm", "dot"):
        for cap in (Capacity(100, 200, 10_000), Capacity(100, 3, 10_000), Capacity(100, 200, 5000)):
            got = packing.pack(df, capacity=cap, by=by).collect()
            assert len(got) == 3000
            n = check(got, cap)
            if by == "norm" and cap.documents == 200 and cap.attention == 10_000:
                assert n <= 1.02 * sum(x for _, x in rows) / 100 + 1


def test_odd_items(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, -5), (4, 11), (5, 10), (5, 10)], "doc_id long, length long")
    got = {}
    for r in packing.pack(df, capacity=Capacity(10, 50, 100)).collect():
        got.setdefault(r["doc_id"], []).append(r["sequence_id"])
    assert got[4] == [None] and len(set(got[5])) == 2 and got[1][0] is not None
    assert packing.pack(df.limit(0)).count() == 0


def test_cut(spark):
    def ids(n):
        return np.arange(n, dtype="<u4").tobytes()
    df = spark.createDataFrame([(n, ids(n), "own") for n in (0, 1, 7, 8, 9, 16, 21)] + [(99, None, "own")],
                               "n long, ids binary, piece string")
    got = {}
    for r in packing.cut(df, size=8).collect():
        got.setdefault(r["n"], []).append((r["piece"], r["start"], r["length"], bytes(r["ids"])))
    assert set(got) == {1, 7, 8, 9, 16, 21}
    for n, parts in got.items():
        parts.sort()
        assert b"".join(p[3] for p in parts) == ids(n) and all(p[2] == 8 for p in parts[1:])
        assert [p[1] for p in parts] == [sum(q[2] for q in parts[:i]) for i in range(len(parts))]
