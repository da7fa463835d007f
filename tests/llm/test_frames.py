import io
import random

import numpy as np
import pytest
import zstandard

from corpusflow.llm import frames


def data(n, seed):
    return np.random.default_rng(abs(seed)).integers(0, 50_000, n).astype("<u4").tobytes()


def test_file_format_and_random_access():
    rng = random.Random(0)
    docs = [(None if i == 0 else i, data(rng.choice([0, 1, 5, 300, 5000]), i)) for i in range(200)]
    f = io.BytesIO()
    w = frames.FrameWriter(f, frame_ids=1000)
    for d in docs:
        w.add(*d)
    w.finish()
    # any zstandard decoder reads the frames and skips the seek table
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(f.getvalue()), read_across_frames=True).read()
    assert plain.startswith(b"".join(x for _, x in docs))
    r = frames.FrameReader(f)
    assert [x for _, x in r.documents()] == [x for _, x in docs]
    r = frames.FrameReader(f)
    assert dict(r.documents(np.array([150]))) == {150: docs[150][1]}
    assert r.read_frames <= 2 < len(r.table)
    broken = bytearray(f.getvalue())
    broken[20] ^= 255
    with pytest.raises(Exception):
        list(frames.FrameReader(io.BytesIO(bytes(broken))).documents())


def test_write_read_lookup(spark):
    rng = random.Random(1)
    rows = [(i, data(rng.choice([0, 3, 70, 900]), i)) for i in rng.sample(range(-500, 500), 300)]
    rows += [(7777, data(30, 1)), (7777, data(31, 2)), (7777, data(30, 1)), (None, data(4, 3)), (8000, None)]
    df = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, ids binary, start string").repartition(4)
    files = frames.write(df, frame_ids=500)
    got = frames.read(files).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in got) == sorted(
        (i is not None, i or 0, x or b"") for i, x in rows)
    got.sort(key=lambda r: (r["start"], r["n_tokens"]))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in got if r["n_tokens"]]
    assert ids == [i for i, x in order if x]
    want = spark.createDataFrame([(7777,), (rows[0][0],), (123456,)], "doc_id long")
    assert sorted((r["doc_id"], bytes(r["ids"])) for r in frames.lookup(files, want).collect()) == sorted(
        (i, x) for i, x in rows if i in (7777, rows[0][0]))


def test_empty(spark):
    files = frames.write(spark.createDataFrame([], "doc_id long, ids binary"))
    assert frames.read(files).count() == 0


def test_hot_id_is_dealt_over_files(spark):
    rows = [(5, data(3, i)) for i in range(900)] + [(None, data(2, i)) for i in range(900)]
    rows += [(i, data(1, i)) for i in range(100, 1000)]
    files = frames.write(spark.createDataFrame(rows, "doc_id long, ids binary").repartition(5))
    sizes = [r["n_docs"] for r in files.listing.collect()]
    assert sum(sizes) == 2700 and max(sizes) < 2700 / 4
    got = sorted(frames.read(files).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [i for i, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(len(got))]
