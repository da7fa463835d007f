"""Document building on inline store requests."""

import json

from pyspark.sql import functions as F

from corpusflow.config import CrawlPolicy
from corpusflow.operators import documents as D


def test_content_resolution(spark):
    req = spark.createDataFrame([
        (0, "https://a/1", "", ""), (1, "https://a/1", "y" * 499, ""), (2, "https://a/1", "y" * 500, ""),
        (3, "https://a/none", "", ""), (4, "https://a/none", "own", ""), (5, "http://a/1", "", ""),
    ], "ordinal long, url string, content string, metadata string")
    cache = spark.createDataFrame([("https://a/1", "CACHED")], "url string, content string")
    got = {r.ordinal: r.content for r in D.document_content(req, cache).collect()}
    assert got == {0: "CACHED", 1: "CACHED", 2: "y" * 500, 3: "(No content available)", 4: "own",
                   5: "(No content available)"}


def test_metadata_and_keys(spark):
    rows = [("", "{}"), ('{"a": 1}', '{"a":1}'), ("[1, 2]", "[1,2]"), ("not json", '{"raw_metadata":"not json"}'),
            ('"s"', '"s"'), ('{"b": 1.50, "a" : " x  \\" , y "}', '{"b":1.50,"a":" x  \\" , y "}')]
    df = spark.createDataFrame([(m,) for m, _ in rows], "m string")
    got = [r[0] for r in df.select(D.document_metadata(F.col("m"))).collect()]
    assert got == [e for _, e in rows]
    titles = ["Accès à l'information, 2024!", "", "x" * 60 + " tail", "  Tabs\tand  spaces  "]
    df = spark.createDataFrame([(t, "https://x/1") for t in titles], "title string, url string")
    keys = [r[0] for r in df.select(D.document_key(F.col("title"), F.col("url"))).collect()]
    import hashlib
    h = hashlib.md5(b"https://x/1").hexdigest()[:12]
    assert keys == [f"Accès_à_linformation_2024_{h}", f"_{h}", "x" * 50 + f"_{h}", f"Tabs\tand__spaces_{h}"]


def test_rows_render_sidecar_receipt(spark):
    req = spark.createDataFrame([(0, "https://a.gc.ca/p", "Titre é", "Body", ""),
                                 (1, "https://a.gc.ca/p", "Titre é", "Body2", "{}")],
                                "ordinal long, url string, title string, content string, metadata string")
    docs = D.document_rows(req, "2024-01-01 00:00:00.000001")
    r = docs.orderBy("ordinal").collect()[0]
    assert r.crawled_at == "2024-01-01T00:00:00.000001+00:00"
    assert D.document_rows(req, "2024-01-01 00:00:00").first().crawled_at == "2024-01-01T00:00:00+00:00"
    pol = CrawlPolicy(bucket="b")
    rend = D.rendered(docs, pol).orderBy("ordinal").collect()
    assert rend[0].body == ("# Titre é\n\n**Source:** https://a.gc.ca/p\n**Crawled:** "
                            "2024-01-01T00:00:00.000001+00:00\n\n---\n\nBody\n")
    j = json.loads(D.rendered(docs, pol.with_(output_format="json")).orderBy("ordinal").first().body)
    assert list(j) == ["source_url", "title", "content", "crawled_at", "metadata"] and j["metadata"] == {}
    side = json.loads(D.sidecar(D.rendered(docs, pol)).first().sidecar)
    assert side["metadataAttributes"]["source_url"] == {
        "value": {"type": "STRING", "stringValue": "https://a.gc.ca/p"}, "includeForEmbedding": False}
    rec = D.store_receipt(D.rendered(docs, pol), pol).orderBy("ordinal").collect()
    assert [x.total_documents_stored for x in rec] == [1, 2]
    assert rec[0].s3_path.startswith("s3://b/crawled-docs/") and rec[0].s3_path.endswith(".md")
    last = D.latest_document(docs.select("filename", "ordinal", "content")).collect()
    assert len(last) == 1 and last[0].content == "Body2" and last[0].writes == 2
