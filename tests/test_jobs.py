"""End-to-end crawl job and question job on the sf0.001 tables."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from corpusflow.config import TEST_POLICY, ChunkConfig
from corpusflow.operators.extract import extract_pages
from corpusflow.plans.jobs import ask_job, crawl_job
from corpusflow.sources import tables as T


def test_crawl_then_ask(spark):
    pol = TEST_POLICY.with_(boilerplate_tags=("script", "style", "footer", "header", "aside", "noscript"),
                            min_content_length=1500, max_link_depth=2, max_pages=1000,
                            allowed_domains=(".example.com", ".example.org", ".example.net"))
    snap = T.fetch_log(spark, SF_SMALL, transform=lambda df: extract_pages(df, pol))
    urls = [r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").orderBy("page_id").collect()]
    payloads = spark.createDataFrame([(0, json.dumps({"urls": urls}))], "payload_id long, payload string")
    res = crawl_job(spark, payloads, snap, pol, "2024-01-01 00:00:00", chunk_cfg=ChunkConfig(size=120, overlap=20, dim=32))
    sess = res.session
    assert sess.filter("depth = 0").count() == len(urls)
    follow = sess.filter("depth > 0")
    assert follow.count() > 0                       # thin pages handed back links
    assert follow.filter("verdict = 'not_captured'").count() == follow.count()
    summary = res.summary.first()
    stored = sess.filter("verdict = 'ok' AND kind = 'ok'").count()
    assert summary.documents_stored == stored == res.documents.count() > 0
    chunks = spark.read.parquet(res.chunk_path)
    assert chunks.select("doc_id").distinct().count() == res.documents.select("filename").distinct().count()
    qs = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select(F.col("item_id").alias("q_id"), "text")
    ans = ask_job(spark, qs, res.chunk_path, 32, k=3)
    assert ans.hits.groupBy("q_id").count().filter("count <> 3").count() == 0
    src = ans.sources.collect()
    assert src and all(s.display.startswith("http") for s in src)
    assert ans.context.count() == qs.count()
