"""Registered document-building queries over the ``documents`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import TEST_CRAWLED_AT, TEST_POLICY
from ..operators import documents as D
from ..session import scratch_path
from ..sources import tables as T
from ..sources.keyed import store_documents

POLICY = TEST_POLICY.with_(bucket="corpus-bucket")
JSON_POLICY = POLICY.with_(output_format="json")


def _docs(spark, sf):
    req = D.document_content(T.store_requests(spark, sf), T.page_cache(spark, sf))
    return D.document_rows(req, TEST_CRAWLED_AT)


def q_document_content(spark, sf):
    r = D.document_content(T.store_requests(spark, sf), T.page_cache(spark, sf))
    return r.select("ordinal", "url", "content", "from_cache")


def q_document_metadata(spark, sf):
    r = T.store_requests(spark, sf)
    return r.select("ordinal", D.document_metadata(F.col("metadata")).alias("metadata"))


def q_document_keys(spark, sf):
    r = T.store_requests(spark, sf)
    return r.select("ordinal", D.document_key(F.col("title"), F.col("url")).alias("filename"))


def q_document_rows(spark, sf):
    d = _docs(spark, sf)
    return d.select("ordinal", "filename", "source_url", "title", F.md5("content").alias("content_md5"),
                    "crawled_at", "metadata")


def q_store_receipt(spark, sf):
    return D.store_receipt(D.rendered(_docs(spark, sf), POLICY), POLICY)


def q_markdown_docs(spark, sf):
    return D.rendered(_docs(spark, sf), POLICY).select("ordinal", "key", "body")


def q_json_docs(spark, sf):
    return D.rendered(_docs(spark, sf), JSON_POLICY).select("ordinal", "key", "body")


def q_sidecar_docs(spark, sf):
    return D.sidecar(D.rendered(_docs(spark, sf), POLICY))


def q_latest_document(spark, sf):
    d = _docs(spark, sf).select("filename", "ordinal", "content")
    return D.latest_document(d).select("filename", "ordinal", F.md5("content").alias("content_md5"), "writes")


def q_document_store(spark, sf):
    """The document store after two runs, one for each pass of store calls;
    the second rewrites only the buckets of its keys."""
    d = _docs(spark, sf).select("filename", "ordinal", "content")
    root = scratch_path(spark, "document-store")
    second = F.col("ordinal") >= T.ORDINAL_STRIDE
    for some in (~second, second):
        store_documents(d.filter(some), root)
    return spark.read.parquet(root).select("filename", "ordinal", F.md5("content").alias("content_md5"), "writes")
