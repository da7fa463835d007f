import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import licences, queries

from .helpers import CLASHES, ODD, documents, full_documents

TOKEN = re.compile(licences.TOKEN)


def words_of(text):
    return TOKEN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def cells(x):
    return {(x // 16 * 2), ((x + 8) // 16) * 2 + 1}


def brute(texts):
    """Per text (n_words, base places by label, found templates with score)."""
    vocabulary = {w for t in licences.TEMPLATES for w in words_of(t.text)} | {w for p, _ in licences.BASE for w in p.split()}
    df = Counter(w for t in texts for w in set(words_of(t)) & vocabulary)
    weight = {w: max(1, round(1000 * math.log((len(texts) + 1) / (df[w] + 1)))) for w in vocabulary}
    out = []
    for text in texts:
        ws = words_of(text)

        def at(phrase):
            return [i for i in range(len(ws)) if ws[i:i + len(phrase)] == phrase]
        base = {label: at(p.split()) for p, label in licences.BASE}
        found = {}
        for t in licences.TEMPLATES:
            tw, phrases = words_of(t.text), [words_of(p) for p in t.phrases]
            if not {w for p in phrases for w in p} <= set(ws):
                continue
            speak = {w: {c for i, x in enumerate(ws) if x == w for j, y in enumerate(tw) if y == w for c in cells(i - j)}
                     for w in set(tw)}
            probes = [w for w in sorted(set(tw), key=lambda w: (-weight[w], w)) if w in ws][:licences.PROBES]
            votes = Counter(c for w in probes for c in speak[w])
            left = {c for c, n in votes.items() if 2 * n >= len(probes)}
            for p in phrases:
                home = next(i for i in range(len(tw)) if tw[i:i + len(p)] == p)
                left &= {c for i in at(p) for c in cells(i - home)}
            if left:
                score = max(sum(weight[w] for w in set(tw) if c in speak[w]) for c in left) / sum(weight[w] for w in set(tw))
                if score >= licences.SHARE:
                    found[t.name] = score
        out.append((len(ws), base, found))
    return out


def rows_of(df):
    return [(r["text"], r["licence"]["n_words"], {b["label"]: b["places"] for b in r["licence"]["base"]},
             {m["name"]: m["score"] for m in r["licence"]["found"]}) for r in df.collect()]


def damaged(text, rng, n):
    ws = text.split()
    for _ in range(n):
        i = rng.randrange(len(ws))
        ws[i:i + 1] = rng.choice([[], ["other"], [ws[i], "more"], [ws[i].upper()]])
    return " ".join(ws)


def sample(seed):
    rng = random.Random(seed)
    filler = "the of and to license licensed under version software permission public general mit 2 0 work by cc".split()
    texts = []
    for _ in range(120):
        parts = [" ".join(rng.choice(filler) for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            parts += [damaged(rng.choice(licences.TEMPLATES).text, rng, rng.randint(0, 4)), rng.choice(["\n", " -- ", "…"])]
            parts.append(" ".join(rng.choice(filler) for _ in range(rng.randint(0, 30))))
        texts.append(" ".join(parts))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    texts = sample(seed)
    want = sorted((t, *w) for t, w in zip(texts, brute(texts)))
    assert sum(bool(w[3]) for w in want) > 40
    got = sorted(rows_of(licences.scan(documents(spark, list(enumerate(texts))))), key=lambda r: r[0])
    assert got == sorted(want, key=lambda r: r[0])


@pytest.mark.parametrize("t", licences.TEMPLATES, ids=lambda t: t.name)
def test_every_template_finds_itself(t):
    ws = words_of(t.text)
    assert t.name in brute([t.text, "other text"])[0][2] and brute([t.text, "other text"])[0][2][t.name] == 1.0
    assert all(licences.place_of(words_of(p), ws) >= 0 for p in t.phrases)


def test_odd_rows(spark):
    rows = ODD + [(20, "MIT License " * 3000), (21, "mit\x00license"), (22, "mitlicense MIT-licenseé"), (23, "x" * 200_000)]
    rows += [(24, "Released under the MIT License.")] * 3
    df = documents(spark, rows, CLASHES + ("licence", "words", "hits", "w"))
    got = {}
    for r in licences.scan(df).collect():
        assert r["tag"] == "own tag" and r["words"] == "own words"
        got.setdefault(r["doc_id"], []).append(r["licence"])
    assert [len(b["places"]) for b in got[20][0]["base"]] == [3000, 0, 0]
    assert [b["places"] for b in got[21][0]["base"]] == [[0], [], []] and got[21][0]["n_words"] == 2
    assert not got[22][0]["base"][0]["places"] and got[1][0]["n_words"] == 0
    assert len(got[24]) == 3 and all([m["name"] for m in g["found"]] == ["mit-notice"] for g in got[24])
    assert licences.scan(documents(spark, [])).count() == 0


def test_query_equals_brute_force_on_the_whole_table(spark):
    from conftest import SF_CHECK
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    want = {}
    label = {t.name: t.label for t in licences.TEMPLATES}
    for (doc, _), (n, base, found) in zip(docs, brute([t for _, t in docs])):
        at = [i for p in base.values() for i in p]
        own = {b for b, p in base.items() if p}
        want[doc] = (n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)),
                     ",".join(sorted(own | {label[f] for f in found})), max(found.values(), default=0.0))
    got = {r["doc_id"]: tuple(r)[1:8] for r in queries.op11_rare_token_index(spark, SF_CHECK).collect()}
    assert got == want


def test_no_python_on_the_executors(spark, tmp_path):
    full_documents(spark, [(1, "Released under the MIT License.")]).write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries.op11_rare_token_index(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapIn", plan)


def test_sql_equals_brute_force(tmp_path):
    """The oracle SQL on damaged notices, where scores lie between 0 and 1."""
    import duckdb
    texts = sample(3) + [None, "", "mit license" * 3, "MIT License " * 200]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    label = {t.name: t.label for t in licences.TEMPLATES}
    want = []
    for doc, (n, base, found) in enumerate(brute(texts)):
        at = [i for p in base.values() for i in p]
        own = {b for b, p in base.items() if p}
        want.append((doc, n, len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)),
                     ",".join(sorted(own | {label[f] for f in found})), max(found.values(), default=0.0)))
    assert sorted(r[:8] for r in con.execute(queries.OP11_SQL).fetchall()) == want
