import random

import numpy as np
import pytest

from corpusflow.llm import suffix

from .helpers import CLASHES, ODD, documents


def brute(rows):
    """(text, kept bytes, removed runs) by comparing every 100-byte string."""
    seen, out = set(), []
    for _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                gone[i:i + 100] = True
            seen.add(raw[i:i + 100])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((text or "", np.frombuffer(raw, np.uint8)[~gone].tobytes(), runs))
    return sorted(out)


def found(df):
    return sorted((r["text"] or "", bytes(r["kept"]), len(r["removed"]))
                  for r in suffix.drop_repeats(df, spans="removed").collect())


def tricky(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé \n") for _ in range(600)) for _ in range(5)]
    rows = []
    for d in range(n):
        text = ""
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < .5:
                b, i = rng.choice(base), rng.randint(0, 400)
                text += b[i:i + rng.randint(60, 260)]
            elif kind < .6:
                text += "a" * rng.randint(50, 300)
            elif kind < .7:
                text += "ab" * rng.randint(20, 200)
            else:
                text += "".join(rng.choice("xyzw ") for _ in range(rng.randint(1, 150)))
        rows.append((rng.choice([d, -d]), text))
    return rows


@pytest.mark.parametrize("chunk,share", [(1 << 21, 0.01), (700, 0.01), (1 << 21, 0.004)])
def test_equals_brute_force(spark, monkeypatch, chunk, share):
    """Also with tiny chunks, and with most q-grams taken for common ones."""
    monkeypatch.setattr(suffix, "CHUNK", chunk)
    monkeypatch.setattr(suffix, "COMMON_SHARE", share)
    rows = {i: t for i, t in tricky(3, 110)}
    rows |= {300: None, 301: "", 302: "q" * 99, 303: "q" * 100, 304: "q" * 350}
    rows = list(rows.items())
    assert found(documents(spark, rows)) == brute(rows)


def test_exact_length():
    rng = random.Random(1)
    ids = suffix.bucket_ids(np.frombuffer(bytes(rng.randrange(256) for _ in range(100)), np.uint8))
    assert len(ids) == 76 and len(suffix.bucket_ids(np.zeros(24, np.uint8))) == 0


def test_odd_rows(spark):
    rows = ODD + [(12, "x" * 5000), (12, "x" * 5000), (None, "z" * 120), (-(1 << 63), "z" * 120)]
    got = suffix.drop_repeats(documents(spark, rows, CLASHES), spans="runs", kept="rest", kept_text="t").collect()
    assert len(got) == len(rows) and all(r["tag"] == "own tag" and r["kept"] == "own kept" for r in got)
    long = sorted(len(r["rest"]) for r in got if r["doc_id"] == 12)
    assert long == [0, 0]                              # the earlier copy is in document 8
    assert sorted(len(r["rest"]) for r in got if r["text"] == "z" * 120) == [0, 1]      # its own repeat, too
    cut = [r for r in got if r["doc_id"] == 8][0]
    assert [(s["at"], s["end"]) for s in cut["runs"]] == [(1, 5000)] and cut["t"] == "x"
    assert suffix.drop_repeats(documents(spark, [])).count() == 0


def test_text_loses_whole_characters(spark):
    shared = "é" * 80
    rows = [(1, "a" + shared), (2, "bb" + shared + "end")]
    got = {r["doc_id"]: r["kept_text"] for r in suffix.drop_repeats(documents(spark, rows)).collect()}
    assert set(got[1]) <= set("aé") and got[2] == "bbend"


def test_settle_over_batch_borders():
    """Any cut of the sorted rows into batches settles the same."""
    import pyarrow as pa
    rng = random.Random(7)
    rows = sorted((rng.randrange(6), rng.randrange(3), rng.randrange(9), rng.randrange(50) << 16 | rng.choice([0, 5, 255]))
                  for _ in range(80))

    def run(cuts):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i:j]], pa.int64()) for k in range(4)],
                                              ["g", "h", "tag", "at"]) for i, j in zip([0, *cuts], [*cuts, len(rows)])]
        return sorted(tuple(x.values()) for b in suffix.settle(iter(batches)) for x in b.to_pylist())
    whole = run([])
    for _ in range(50):
        assert run(sorted(rng.sample(range(1, 80), rng.randint(1, 40)))) == whole


def test_one_document_repeats_itself_over_many_runs(spark):
    """Runs of one row come back from a shuffle in any order; the first
    occurrence stays."""
    rng = random.Random(11)
    part = ["".join(rng.choice("abcdefgh ") for _ in range(130)) for _ in range(6)]
    rows = []
    for d in range(8):
        text = ""
        for _ in range(60):
            p = rng.choice(part)
            i = rng.randint(0, 20)
            text += p[i:i + rng.randint(62, 110)] + rng.choice(["", "#", "@@", p[:40]])
        rows.append((d, text))
    assert found(documents(spark, rows)) == brute(rows)


def test_query_equals_brute_force_on_the_whole_table(spark):
    import hashlib

    from corpusflow.llm import queries

    from conftest import SF_CHECK
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    want = {}
    seen = set()
    for doc, text in sorted(rows):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                gone[i:i + 100] = True
            seen.add(raw[i:i + 100])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        want[doc] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op8_suffix_dedup(spark, SF_CHECK).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert got == want


def test_runs_of_a_slice_are_in_text_order():
    text = bytes(random.Random(5).randrange(97, 123) for _ in range(3000))
    c = suffix.Chunk([1], [1], [0], [text])
    anchor, lo, hi = c.anchors()
    rows = lo << 16 | (anchor - lo) << 8 | (hi - lo)
    got = suffix.runs_of(c, [np.random.default_rng(3).permutation(rows)])
    assert all((g == w).all() for g, w in zip(got, (anchor, lo, hi)))
