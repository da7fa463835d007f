"""Tables kept in hash buckets: upserts and chunk refresh."""

import os

from pyspark.sql import functions as F

from corpusflow.config import ChunkConfig
from corpusflow.operators.documents import latest_document
from corpusflow.session import scratch_path
from corpusflow.sources.keyed import refresh_chunks, store_documents

CFG = ChunkConfig(size=6, overlap=2, dim=8)


def files(root):
    root = root.removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def calls(spark, first, last):
    n = F.col("id")
    return spark.range(first, last).select(F.concat(F.lit("doc"), n % 97).alias("filename"), n.alias("ordinal"),
                                           F.concat(F.lit("body "), n.cast("string")).alias("content"))


def test_store_runs_equal_one_batch(spark):
    root = scratch_path(spark, "t-store")
    for a, b in ((0, 150), (150, 170), (170, 400)):
        store_documents(calls(spark, a, b), root)
    want = sorted(map(tuple, latest_document(calls(spark, 0, 400)).select("filename", "ordinal", "content", "writes").collect()))
    got = spark.read.parquet(root).select("filename", "ordinal", "content", "writes")
    assert sorted(map(tuple, got.collect())) == want
    before = files(root)
    one = spark.createDataFrame([("doc5", 401, "new"), ("doc5", 402, "newer")], "filename string, ordinal long, content string")
    store_documents(one, root)
    changed = {f.split("/")[0] for f in before ^ files(root)}
    assert len(changed) == 1                                   # only the bucket of its key was written
    r = spark.read.parquet(root).filter("filename = 'doc5'").first()
    assert (r["ordinal"], r["content"]) == (402, "newer")
    store_documents(one, root)                                 # a repeated run
    store_documents(calls(spark, 5, 6), root)                  # a late one
    assert tuple(spark.read.parquet(root).filter("filename = 'doc5'").first())[:4] == tuple(r)[:4]
    store_documents(one.limit(0), root)
    assert spark.read.parquet(root).count() == 97


def documents(spark, rows):
    return spark.createDataFrame([(i, f"https://d/{i}", f"T{i}", t, f"s3://b/{i}") for i, t in rows],
                                 "doc_id long, source_url string, title string, text string, uri string")


def table(spark, root):
    return sorted((r["chunk_id"], r["doc_id"], r["pos"], r["text"], r["metadata"], tuple(r["vector"]), r["uri"])
                  for r in spark.read.parquet(f"{root}/chunks").collect())


def test_chunk_refresh_equals_a_full_run(spark):
    def text(i, word="w"):
        return " ".join(f"{word}{i}x{k}" for k in range(3 + i % 20))
    first = [(i, text(i)) for i in range(120)]
    second = [(i, text(i, "new") if i % 10 == 3 else text(i)) for i in range(0, 130) if i % 15 != 7] + [(500, None), (501, "")]
    root, whole = scratch_path(spark, "t-chunks"), scratch_path(spark, "t-chunks-2")
    assert refresh_chunks(documents(spark, first), CFG, root) == 120
    old = dict(first)
    altered = sum(old.get(i, 0) != t for i, t in second)
    assert refresh_chunks(documents(spark, second), CFG, root) == altered
    refresh_chunks(documents(spark, second), CFG, whole)
    assert table(spark, root) == table(spark, whole)
    before = files(root)
    assert refresh_chunks(documents(spark, second), CFG, root) == 0 and files(root) == before
    assert refresh_chunks(documents(spark, second[:1]), CFG, root) == 0      # all others are removed
    assert {r[1] for r in table(spark, root)} == {second[0][0]}


def recorded(monkeypatch):
    """Names of the scratch folders that a change writes."""
    from corpusflow.sources import keyed
    names = []
    monkeypatch.setattr(keyed, "scratch_path", lambda spark, name: names.append(name) or scratch_path(spark, name))
    return names


def test_bodies_are_staged_once(spark, monkeypatch):
    names, root = recorded(monkeypatch), scratch_path(spark, "t-store")
    kind = "filename string, ordinal long, content string"
    store_documents(spark.createDataFrame([("a", 1, "a1"), ("b", 2, "b2"), (None, 3, "x"), ("c", None, "c")], kind), root)
    store_documents(spark.createDataFrame([("a", 4, "a4"), ("a", 5, "a5"), ("b", 2, "late"), ("d", 6, "d6"), (None, 7, "y")], kind), root)
    store_documents(spark.createDataFrame([("d", 8, "d8")], kind), root)
    got = spark.read.parquet(root).select("filename", "ordinal", "content", "writes").collect()
    assert sorted(map(tuple, got)) == [("a", 5, "a5", 3), ("b", 2, "b2", 1), ("d", 8, "d8", 2)]
    assert names == ["store-calls", "last-calls"] * 3


def test_first_refresh_writes_chunks_once_and_emptied_buckets_go(spark, monkeypatch):
    names, root = recorded(monkeypatch), scratch_path(spark, "t-chunks")
    rows = [(i, f"a b c{i}") for i in range(40)] + [(None, "no id"), (90, None), (91, " ")]
    assert refresh_chunks(documents(spark, rows), CFG, root) == 43
    assert names == ["document-hashes", "changed-documents"]
    assert sorted({r[1] for r in table(spark, root)}) == list(range(40))
    assert refresh_chunks(documents(spark, [(i, "" if i else "z") for i in range(40)]), CFG, root) == 40
    assert [(r[1], r[3]) for r in table(spark, root)] == [(0, "z")]
    assert len(files(f"{root}/chunks")) == 1
