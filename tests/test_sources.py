"""Document store round trip, folder corpus reader, schedule and k-th
smallest helpers."""

import json
import os

from pyspark.sql import functions as F

from corpusflow.config import CrawlPolicy
from corpusflow.operators.reports import request_schedule
from corpusflow.operators.session import kth_smallest
from corpusflow.session import scratch_path
from corpusflow.sources.corpus import corpus_scan, read_text_corpus, write_store


def test_store_scan_roundtrip_with_missing_sidecar(spark):
    objs = spark.createDataFrame([("p/a.md", "A"), ("p/b.md", "B"), ("q/c.md", "C")], "key string, body string")
    side = spark.createDataFrame([("p/a.md.metadata.json", json.dumps({"metadataAttributes": {
        "source_url": {"value": {"type": "STRING", "stringValue": "https://w/a"}, "includeForEmbedding": False},
        "title": {"value": {"type": "STRING", "stringValue": "Ta"}, "includeForEmbedding": False}}}))],
        "sidecar_key string, sidecar string")
    root = write_store(objs, side, scratch_path(spark, "t-store"))
    got = {r.key: (r.source_url, r.title) for r in corpus_scan(spark, root, "p/").collect()}
    assert got == {"p/a.md": ("https://w/a", "Ta"), "p/b.md": ("store://p/b.md", "")}


def test_read_text_corpus(spark):
    folder = scratch_path(spark, "t-files").removeprefix("file:")
    os.makedirs(folder)
    with open(os.path.join(folder, "x.md"), "w", encoding="utf-8") as f:
        f.write("# X\n\nbody line\n")
    with open(os.path.join(folder, "y.md"), "w", encoding="utf-8") as f:
        f.write("# Y\n")
    with open(os.path.join(folder, "x.md.metadata.json"), "w", encoding="utf-8") as f:
        json.dump({"metadataAttributes": {"source_url": {"value": {"type": "STRING", "stringValue": "https://w/x"},
                                                         "includeForEmbedding": False}}}, f)
    rows = {os.path.basename(r.path): r for r in read_text_corpus(spark, folder).collect()}
    assert set(rows) == {"x.md", "y.md"}
    assert rows["x.md"].body == "# X\n\nbody line\n" and rows["x.md"].source_url == "https://w/x"
    assert rows["y.md"].source_url.endswith("y.md") and rows["y.md"].title == ""


def test_request_schedule(spark):
    s = spark.createDataFrame([(0, "https://a/0", "ok"), (5, "https://a/1", "domain"), (9, "https://a/2", "http_error"),
                               (70000, "https://a/3", "ok"), (70001, "https://a/4", "budget")],
                              "ordinal long, fetch_url string, verdict string")
    got = [(r.ordinal, r.slot, r.start_offset_us) for r in
           request_schedule(s, CrawlPolicy(request_delay=0.5)).orderBy("ordinal").collect()]
    assert got == [(0, 0, 0), (9, 1, 500000), (70000, 2, 1000000)]


def test_kth_smallest(spark):
    vals = [i * 977 % 500000 for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    s = sorted(vals)
    for k in (1, 7, 1000, 2000):
        assert kth_smallest(df, "v", k) == s[k - 1]
    assert kth_smallest(df, "v", 2001) is None


def test_files_with_sidecars(spark):
    from corpusflow.sources.corpus import file_corpus, write_files
    from corpusflow.sources.files import place
    keys = ["p/a.md", "p/Ünï_日本%2F.md", "_hidden", ".dot", "p/\\x\t.md", "q/c.md"] + [f"p/n{i}.md" for i in range(60)]
    side_of = {k: json.dumps({"metadataAttributes": {
        "source_url": {"value": {"type": "STRING", "stringValue": f"https://w/{k}"}, "includeForEmbedding": False},
        "title": {"value": {"type": "STRING", "stringValue": "T"}, "includeForEmbedding": False}}})
        for i, k in enumerate(keys) if i % 3}
    objs = spark.createDataFrame([(k, f"body of {k}\n") for k in keys], "key string, body string").repartition(3)
    side = spark.createDataFrame([(k + ".metadata.json", s) for k, s in side_of.items()], "sidecar_key string, sidecar string")
    root = scratch_path(spark, "t-doc-files")
    want = {k: (f"body of {k}\n", f"https://w/{k}" if k in side_of else f"store://{k}", "T" if k in side_of else "") for k in keys}
    for _ in range(2):                                       # a repeated run leaves the same files
        write_files(objs, side, root)
        assert {r.key: (r.body, r.source_url, r.title) for r in file_corpus(spark, root).collect()} == want
    assert {r.key for r in file_corpus(spark, root, "q/").collect()} == {"q/c.md"}
    write_files(objs, side.filter("sidecar_key <> 'p/n1.md.metadata.json'"), root)        # a sidecar that goes
    assert "p/n1.md" in side_of and file_corpus(spark, root).filter("key = 'p/n1.md'").first().title == ""
    names = [n for _, _, f in os.walk(root.removeprefix("file:")) for n in f]
    assert len(names) == len(set(names)) == len(keys) + len(side_of) - 1 + 1 and not any(n.startswith(".") and n.endswith(".tmp") for n in names)
    assert len({place(k) for k in keys}) == len(keys)
