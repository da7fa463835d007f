import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import collocations, queries

from .helpers import CLASHES, ODD


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute(rows, least=30, top=2000):
    """Result rows from (lang, text) by listing every phrase."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or "")):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(ws)
            for k in range(1, 5):
                f[lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= 80 * c[p[i:i + k]]:
                        inside.add(p[i:i + k])
        kept = []
        for p, a in cand.items():
            if p not in inside:
                score, cut = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), c[p[:cut]], c[p[cut:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def found(df, **kw):
    return sorted(tuple(r) for r in collocations.collocations(df, **kw).collect())


def table(spark, rows, clashes=()):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    for c in clashes:
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def noisy(seed, n, langs=("en", "de", None, "und", "")):
    rng = random.Random(seed)
    words = [w + rng.choice(["", "", "é", "日"]) for w in "ab cd ef gh ij kl mn op Qr ST uv wx yz".split()]
    weights = [1 / (i + 1) for i in range(len(words))]
    ends = [" ", " ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "!\r\n", "\x0b", ";x:y?"]
    return [(rng.choice(langs), "".join(rng.choices(words, weights)[0] + rng.choice(ends) for _ in range(rng.randint(0, 120))))
            for _ in range(n)]


@pytest.mark.parametrize("chunk,codes,part", [(4 << 20, 60_000, 0.125), (500, 5, 0.125), (4 << 20, 7, 1e-9),
                                              (900, 0, 0.02)])
def test_equals_brute_force(spark, monkeypatch, chunk, codes, part):
    """Also with tiny chunks, a tiny dictionary, and with all words and pairs
    taken for common ones."""
    monkeypatch.setattr(collocations, "CODES", codes)
    monkeypatch.setattr(collocations, "COMMON_PART", part)
    rows = noisy(5, 150)
    want = brute(rows)
    assert len({r[0] for r in want}) == 4 and any(" " in r[2].partition(" ")[2] for r in want)
    assert found(table(spark, rows), chunk=chunk) == want


def test_ranks_end_at_the_limit_and_ties_follow_the_phrase(spark):
    rows = [("en", " . ".join(f"p{i} q{i}" for i in range(40)))] * 30      # equal scores throughout
    got = found(table(spark, rows), top=25)
    assert got == brute(rows, top=25) and len(got) == 25


def test_products_beyond_64_bits(spark):
    phrases = spark.createDataFrame(
        [("en", "a b", 2, 9 * 10**15), ("en", "a", 1, 9 * 10**15 + 1), ("en", "b", 1, 9 * 10**15 + 2)],
        "lang string, phrase string, words int, f long")
    r = collocations.scored(phrases).first()
    assert r["score"] == 2000000 * 9 * 10**15 // (18 * 10**15 + 3) == 999999


def test_odd_rows(spark):
    rows = [("en", t) for _, t in ODD] * 30 + [(None, None), ("x", ""), ("y", "� same \xa0 text " * 40), ("z", "w " * 90_000)]
    assert found(table(spark, rows, ("w1", "n", "phrase", "rank", "f", "words") + CLASHES)) == brute(rows)
    assert found(table(spark, [])) == []


def test_units_cut_only_where_pieces_end():
    rng = random.Random(1)
    for _ in range(200):
        raw = bytes(rng.choice(b"ab \n") for _ in range(rng.randint(0, 60)))
        parts = list(collocations.units(raw, rng.randint(1, 12)))
        assert b"".join(parts) == raw and all(p.endswith(b"\n") for p in parts[:-1])


def test_windows_count_every_place_once():
    w = collocations.Words("en", [b"a b a b a\nb a", b"c"])
    columns, n = w.windows(4)
    got = {tuple(w.words[i - 1].decode() if i else "" for i in c): k for *c, k in zip(*columns, n)}
    assert got == {("a", "b", "a", "b"): 1, ("b", "a", "b", "a"): 1, ("a", "b", "a", ""): 1, ("b", "a", "", ""): 2,
                   ("a", "", "", ""): 2, ("c", "", "", ""): 1}


def test_shortening_keeps_the_sums_of_wanted_prefixes():
    rng = np.random.default_rng(2)
    columns = rng.integers(1, 5, size=(4, 300))
    for k in range(1, 4):
        columns[k:, rng.random(300) < .1] = 0
    columns, n = collocations.summed(columns, rng.integers(1, 9, size=300))

    def sums(columns, n):
        out = collections.Counter()
        for *c, k in zip(*columns.tolist(), n.tolist()):
            for size in range(1, 5):
                if c[size - 1]:
                    out[tuple(c[:size])] += k
        return {p: k for p, k in out.items() if k >= 30}
    for depth in (1, 2, 3):
        short, m = collocations.shortened(columns, n, np.full(len(n), depth), 30)
        assert sums(short, m) == sums(columns, n) and m.sum() == n.sum() and len(m) < len(n)


def test_query_on_the_smallest_tables(spark):
    from conftest import SF_SMALL
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "text").collect()]
    assert sorted(tuple(r) for r in queries.op13_top_order_phrases(spark, SF_SMALL).collect()) == brute(docs)
