import random
import re

import numpy as np
import xxhash

from corpusflow.llm import simhash

from .helpers import CLASHES, ODD, documents, prose


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, bits=2):
    """Component of every index by comparing all pairs."""
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(values))]


def test_fingerprints():
    for text in [t for _, t in ODD + prose(3, 40)] + ["A b", "A B c", "Ä b\x85c d"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 250, dtype=np.uint64)
    values = [base, np.array([0, 1, 3, 7, 2 ** 63, 2 ** 64 - 1], dtype=np.uint64)]
    for _ in range(6):
        near = base[:150].copy()
        for _ in range(int(rng.integers(1, 4))):
            near ^= np.uint64(1) << rng.integers(0, 64, len(near), dtype=np.uint64)
        values.append(near)
    values = np.unique(np.concatenate(values))
    distance = np.bitwise_count(values[:, None] ^ values[None, :])
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)] * 2, "fp long")
    for budget, top in ((2, 12), (2, 5), (1, 12), (3, 8), (0, 12)):
        want = {(int(values[i]), int(values[j])) for i, j in zip(*np.nonzero(np.triu(distance <= budget, 1)))}
        got = [(r["a"] % 2 ** 64, r["b"] % 2 ** 64) for r in simhash.links(df, budget=budget, top_bits=top).collect()]
        assert len(got) == len(want) and set(got) == want


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(40)] + [(500, 501)]
    rng.shuffle(edges)
    nodes = sorted({x for e in edges for x in e} | {900})
    name = {n: n * 7 % 1009 for n in nodes}
    got = dict(simhash.components(
        spark.createDataFrame([(n, name[n]) for n in nodes], "node long, label long"),
        spark.createDataFrame(edges, "a long, b long")).collect())
    assert 900 not in got
    for part in (range(0, 61), [100, *range(200, 240)], [500, 501]):
        assert {got[n] for n in part} == {min(name[n] for n in part)}


def near_copies(seed):
    rng = random.Random(seed)
    rows = []
    for i, (_, text) in enumerate(prose(seed, 40, 150)):
        words = text.split(" ")
        for k in range(rng.choice([1, 1, 2, 5])):
            w = list(words)
            for _ in range(k):
                w[rng.randrange(len(w))] = "changed"
            rows.append((1000 * i + 7 * k, " ".join(w)))
    return rows + ODD + [(None, "one")]


def test_near_duplicates_equal_brute_force(spark):
    rows = near_copies(4)
    fps = [plain_fingerprint(t) for _, t in rows]
    part = groups(fps)
    want = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if part[j] == part[k] and rows[j][0] is not None]
        want.append((i, f"{fps[k]:016x}", min(ids, default=None)))
    got = [tuple(r) for r in simhash.near_duplicates(documents(spark, rows, ("fp", "tag"))).select(
        "doc_id", simhash.as_hex(simhash.F.col("fp")), "component_id").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    stay = simhash.drop_near_duplicates(documents(spark, rows, CLASHES)).collect()
    assert len(stay) == len(set(part)) and stay[0]["fp"] == "own fp"
    assert sorted(part[[r[0] for r in rows].index(r["doc_id"])] for r in stay) == sorted(set(part))


def test_empty(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.drop_near_duplicates(documents(spark, [])).count() == 0
