"""DuckDB oracle SQL for the document queries (``corpusflow.plans.documents``)."""

from __future__ import annotations

from ..config import TEST_CRAWLED_AT
from . import sqlexpr as X

STRIDE = 1 << 40
BUCKET = "corpus-bucket"
PREFIX = "crawled-docs/"


def _ctes() -> str:
    https = "'https://' || source || '.example.org/doc/' || doc_id"
    return f"""WITH base AS (
  SELECT doc_id,
         CASE WHEN doc_id % 5 = 0 THEN 'http://' || source || '.example.org/doc/' || doc_id ELSE {https} END AS url,
         substring(split_part(text, chr(10), 1), 1, 60) AS title,
         CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN substring(text, 1, 499) ELSE text END AS override,
         CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN to_json({{'lang': lang, 'source': source}})::VARCHAR
              WHEN 2 THEN to_json([lang, source])::VARCHAR ELSE 'lang=' || lang END AS metadata
  FROM documents),
req AS (
  SELECT doc_id AS ordinal, doc_id, url, title, override AS content, metadata FROM base
  UNION ALL SELECT doc_id + {STRIDE}, doc_id, url, title, '', metadata FROM base),
cache AS (SELECT {https} AS url, text AS content FROM documents WHERE lang <> 'de'),
resolved AS (
  SELECT r.ordinal, r.url, r.title, r.metadata,
         (c.url IS NOT NULL AND (r.content = '' OR length(r.content) < 500)) AS from_cache,
         CASE WHEN c.url IS NOT NULL AND (r.content = '' OR length(r.content) < 500) THEN c.content
              WHEN r.content = '' THEN '(No content available)' ELSE r.content END AS content
  FROM req r LEFT JOIN cache c ON c.url = r.url),
docs AS (
  SELECT ordinal, {X.doc_key('title', 'url')} AS filename, url AS source_url, title, content,
         strftime(TIMESTAMP '{TEST_CRAWLED_AT}', '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS crawled_at,
         CASE WHEN coalesce(metadata, '') = '' THEN '{{}}'
              WHEN json_valid(metadata) THEN json(metadata)::VARCHAR
              ELSE to_json({{'raw_metadata': metadata}})::VARCHAR END AS metadata
  FROM resolved)"""


def queries() -> dict[str, str]:
    w = _ctes()
    md = ("'# ' || title || chr(10) || chr(10) || '**Source:** ' || source_url || chr(10) || '**Crawled:** ' "
          "|| crawled_at || chr(10) || chr(10) || '---' || chr(10) || chr(10) || content || chr(10)")
    js = ("to_json({'source_url': source_url, 'title': title, 'content': content, 'crawled_at': crawled_at, "
          "'metadata': json(metadata)})::VARCHAR")
    side = ("to_json({'metadataAttributes': {"
            "'source_url': {'value': {'type': 'STRING', 'stringValue': source_url}, 'includeForEmbedding': false}, "
            "'title': {'value': {'type': 'STRING', 'stringValue': title}, 'includeForEmbedding': false}}})::VARCHAR")
    return {
        "document_content": f"{w} SELECT ordinal, url, content, from_cache FROM resolved",
        "document_metadata": f"{w} SELECT ordinal, metadata FROM docs",
        "document_keys": f"{w} SELECT ordinal, {X.doc_key('title', 'url')} AS filename FROM req",
        "document_rows": (f"{w} SELECT ordinal, filename, source_url, title, md5(content) AS content_md5, "
                          f"crawled_at, metadata FROM docs"),
        "store_receipt": (f"{w} SELECT ordinal, true AS stored, './kb_output/' || filename || '.md' AS local_path, "
                          f"row_number() OVER (ORDER BY ordinal) AS total_documents_stored, "
                          f"'s3://{BUCKET}/{PREFIX}' || filename || '.md' AS s3_path FROM docs"),
        "markdown_docs": f"{w} SELECT ordinal, '{PREFIX}' || filename || '.md' AS key, {md} AS body FROM docs",
        "json_docs": f"{w} SELECT ordinal, '{PREFIX}' || filename || '.json' AS key, {js} AS body FROM docs",
        "sidecar_docs": (f"{w} SELECT ordinal, '{PREFIX}' || filename || '.md.metadata.json' AS sidecar_key, "
                         f"{side} AS sidecar FROM docs"),
        "latest_document": (f"{w} SELECT filename, max(ordinal) AS ordinal, md5(arg_max(content, ordinal)) AS content_md5, "
                            f"count(*) AS writes FROM docs GROUP BY filename"),
        "document_store": (f"{w} SELECT filename, ordinal, md5(content) AS content_md5, n AS writes FROM ("
                           f"SELECT *, count(*) OVER (PARTITION BY filename) AS n, row_number() OVER "
                           f"(PARTITION BY filename ORDER BY ordinal DESC) AS r FROM docs) WHERE r = 1"),
    }
