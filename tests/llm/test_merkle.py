import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import merkle, queries

from .helpers import CLASHES, ODD, full_documents


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """(root, per leaf the sibling digests left and right, bottom up)."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for b in range(0, len(nodes), 8):
            run = nodes[b:b + 8]
            for j in range(len(run)):
                for i in under[b + j]:
                    paths[i].append((run[:j], run[j + 1:]))
            up.append(h("".join(run)))
            below.append([i for j in range(len(run)) for i in under[b + j]])
        nodes, under = up, below
    return (nodes[0] if nodes else None), paths


def brute(rows):
    """Result rows from (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = climb([leaf_of(r) for r in groups[g]])
    root, above = climb([trees[g][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        sub, paths = trees[g]
        for r, path in zip(groups[g], paths):
            path = path + above[k]
            d = leaf_of(r)
            fold = d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                fold = leaf_of((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in path:
                fold = h("".join(left) + fold + "".join(right))
            out.append((r[0], d, sub, root, h("".join("".join(a + b) for a, b in path)), fold, fold == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def result(spark, rows, tmp_path, clashes=()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in clashes:
        df = df.withColumn(c, F.lit(f"own {c}"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op12_merkle_intervals(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("sizes", [(1,), (8, 9, 1), (64, 65, 7), (600, 2, 513, 8, 1, 1, 1, 3, 17)])
def test_equals_brute_force(spark, tmp_path, sizes):
    """Trees of one to four levels, lone leaves, and a tree over the groups."""
    rng = random.Random(sum(sizes))
    ids = rng.sample(range(-2000, 2000), sum(sizes))
    rows = [(ids.pop(), "s", f"l{g:02}" if g else None, rng.choice([None, 5]), rng.choice(["Text A", "é B", "", None, "lower"]))
            for g, n in enumerate(sizes) for _ in range(n)]
    assert result(spark, rows, tmp_path) == brute(rows)


def test_odd_rows(spark, tmp_path):
    """Nulls everywhere, repeated ids, equal rows, long texts, clashing columns."""
    rows = [(i, "src", "en", len(t or ""), t) for i, t in ODD]
    rows += [(None, None, None, None, None)] * 2 + [(3, None, "", 1, "Empty lang"), (4, "", "é", None, "X" * 300_000)]
    rows += [(77, "a", "en", 4, "Same")] * 40 + [(78, "a", "en", 5, "Other"), (78, "b", "en", 5, "Other")]
    got = result(spark, rows, tmp_path, ("g", "id", "load", "path", "kids", "lo", "hi", "n", "leaf", "root") + CLASHES)
    assert got == brute(rows)


def test_empty_table(spark, tmp_path):
    assert result(spark, [], tmp_path) == []


def test_whole_path_holds_the_siblings_once(spark):
    rows = [(i, f"Text {i}") for i in range(70)]
    out = merkle.manifest(full_documents(spark, rows), F.col("doc_id"), F.col("lang"), [F.col("text")],
                          F.lit(None).cast("string")).collect()
    _, paths = climb([leaf_of((t,)) for _, t in rows])
    assert {r["id"]: [(s["left"], s["right"]) for s in r["path"]] for r in out} == {
        i: [("".join(a), "".join(b)) for a, b in p] for (i, _), p in zip(rows, paths)}
