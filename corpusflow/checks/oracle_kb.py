"""DuckDB oracle SQL for the knowledge-base queries
(``corpusflow.plans.knowledge``): brute-force chunking, hashed embedding
by GROUP BY, and exact search over the full question x corpus product."""

from __future__ import annotations

from ..config import TEST_CHUNKS
from . import sqlexpr as X
from .oracle_docs import _ctes as doc_ctes

C = TEST_CHUNKS
STEP = C.size - C.overlap
DIM = C.dim
BUCKET_URI = "s3://corpus-bucket/crawled-docs/"


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {X.lit('[' + X.PY_SPACE + ']+')}), lambda w: w <> '')"


def _weights(src: str, id_col: str) -> str:
    """Sparse float weights ``(id, bucket, w)`` of ``src(id, text)``."""
    toks = f"list_filter(regexp_split_to_array(lower(text), {X.lit(r'[^\p{L}\p{N}]+')}), lambda t: t <> '')"
    return f"""(
  WITH t AS (SELECT {id_col} AS id, unnest({toks}) AS tok FROM {src}),
       c AS (SELECT id, CAST(('0x' || substr(md5(tok), 1, 8))::BIGINT % {DIM} AS INTEGER) AS bucket,
                    count(*) AS n FROM t GROUP BY ALL)
  SELECT id, bucket, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS FLOAT) AS w FROM c)"""


def _dense(ids: str, weights: str) -> str:
    return f"""(
  SELECT i.id, list(coalesce(w.w, CAST(0 AS FLOAT)) ORDER BY r.b) AS v
  FROM {ids} i CROSS JOIN range({DIM}) r(b)
  LEFT JOIN {weights} w ON w.id = i.id AND w.bucket = r.b
  GROUP BY i.id)"""


def _ctes() -> str:
    return f"""WITH docs0 AS (
  SELECT doc_id, 'https://' || source || '.example.org/doc/' || doc_id AS source_url,
         substring(split_part(text, chr(10), 1), 1, 60) AS title, text FROM documents),
docs AS (SELECT *, {X.doc_key('title', 'source_url')} AS filename FROM docs0),
kbdocs AS (SELECT *, '{BUCKET_URI}' || filename || '.md' AS uri, {_words('text')} AS ws FROM docs),
chunks AS (
  SELECT doc_id, source_url, title, uri, CAST(p AS INTEGER) AS pos, doc_id || '-' || p AS chunk_id,
         array_to_string(ws[p * {STEP} + 1 : p * {STEP} + {C.size}], ' ') AS text
  FROM kbdocs, range(CASE WHEN len(ws) <= {C.size} THEN 1
                          ELSE CAST(ceil((len(ws) - {C.size}) / {STEP}) AS BIGINT) + 1 END) t(p)
  WHERE len(ws) > 0),
cw AS {_weights('chunks', 'chunk_id')},
cv AS {_dense('(SELECT chunk_id AS id FROM chunks)', 'cw')},
qs AS (SELECT item_id, text FROM benchmark),
qw AS {_weights('qs', 'item_id')},
qv AS {_dense('(SELECT item_id AS id FROM qs)', 'qw')},
hits AS (
  SELECT * FROM (
    SELECT q.id AS q_id, c.id AS chunk_id, list_distance(q.v::DOUBLE[], c.v::DOUBLE[]) AS d,
           CAST(row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.v::DOUBLE[], c.v::DOUBLE[]), c.id)
                AS INTEGER) AS rank
    FROM qv q CROSS JOIN cv c) WHERE rank <= 5),
ret AS (
  SELECT h.q_id, h.rank, h.chunk_id, h.d, 1.0 / (1.0 + h.d * h.d) AS score, ch.text, ch.uri,
         ch.source_url, ch.title
  FROM hits h JOIN chunks ch ON ch.chunk_id = h.chunk_id),
refs AS (
  SELECT q_id, CAST((rank - 1) // 2 AS INTEGER) AS citation_no, CAST((rank - 1) % 2 AS INTEGER) AS ref_no, uri,
         CASE rank WHEN 1 THEN json_object('source_url', source_url, 'title', title)
                   WHEN 2 THEN json_object('source_url', json_object('type', 'STRING', 'stringValue', source_url),
                                           'title', json_object('stringValue', title))
                   WHEN 3 THEN json_object('source_url', json_object('value', source_url),
                                           'title', json_object('value', title))
                   WHEN 4 THEN json_object('source_url', json_object(), 'title', title)
                   ELSE json_object() END::VARCHAR AS metadata
  FROM ret),
flat0 AS (SELECT q_id, citation_no, ref_no, uri, {_attr('source_url')} AS source_url,
                 {_attr('title')} AS title FROM refs),
flat AS (SELECT *, CASE WHEN source_url <> '' THEN source_url ELSE uri END AS display FROM flat0),
dedupe AS (
  SELECT q_id, display, arg_min(title, citation_no * 1000 + ref_no) AS title,
         min(citation_no * 1000 + ref_no) AS first_pos FROM flat GROUP BY q_id, display),
sources AS (SELECT q_id, CAST(row_number() OVER (PARTITION BY q_id ORDER BY first_pos) AS INTEGER) AS source_no,
                  display, title FROM dedupe)"""


def _attr(key: str) -> str:
    p = f"'$.{key}'"
    return (f"CASE WHEN json_type(metadata, {p}) = 'OBJECT' THEN "
            f"CASE WHEN json_exists(metadata, '$.{key}.stringValue') "
            f"THEN coalesce(json_extract_string(metadata, '$.{key}.stringValue'), '') "
            f"ELSE coalesce(json_extract_string(metadata, '$.{key}.value'), '') END "
            f"ELSE coalesce(json_extract_string(metadata, {p}), '') END")


def queries() -> dict[str, str]:
    w = _ctes()
    q = {
        "chunk_documents": (f"{w} SELECT chunk_id, doc_id, pos, CAST(len({_words('text')}) AS INTEGER) AS n_words, "
                            f"md5(text) AS text_md5 FROM chunks"),
        "chunk_metadata": (f"{w} SELECT chunk_id, doc_id, uri, to_json({{'source_url': source_url, 'title': title}})::VARCHAR "
                           f"AS metadata FROM chunks"),
        "embed_chunks": f"{w} SELECT id AS chunk_id, bucket, round(w::DOUBLE, 6) AS weight FROM cw",
        "vector_topk": f"""{w} SELECT item_id, rank, vec_id, round(d, 6) AS distance FROM (
  SELECT q.id AS item_id, e.vec_id, list_distance(q.v::DOUBLE[], e.embedding::DOUBLE[]) AS d,
         CAST(row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.v::DOUBLE[], e.embedding::DOUBLE[]), e.vec_id)
              AS INTEGER) AS rank
  FROM qv q CROSS JOIN embeddings e) WHERE rank <= 5""",
        "retrieve": (f"{w} SELECT q_id AS item_id, rank, chunk_id, round(score, 6) AS score, "
                     f"substring(text, 1, 300) AS snippet, uri FROM ret"),
        "citation_flatten": (f"{w} SELECT q_id AS item_id, citation_no, ref_no, uri, source_url, title, display "
                             f"FROM flat"),
        "citation_dedupe": f"{w} SELECT q_id AS item_id, source_no, display, title FROM sources",
        "citations": (f"{w} SELECT s.q_id AS item_id, md5(b.text) AS question_md5, source_no, display, title "
                      f"FROM sources s JOIN benchmark b ON b.item_id = s.q_id"),
        "rag_context": (f"{w} SELECT q_id AS item_id, md5(ctx) AS context_md5, CAST(length(ctx) AS INTEGER) AS context_length, "
                        f"CAST(n AS INTEGER) AS n_chunks FROM (SELECT q_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS ctx, "
                        f"count(*) AS n FROM ret GROUP BY q_id)"),
        "answer_grounding": (f"{w} SELECT q_id AS item_id, CAST(count(DISTINCT citation_no) AS INTEGER) AS n_citations, "
                             f"count(*) AS n_refs, count(DISTINCT display) AS n_sources FROM flat GROUP BY q_id"),
        "chunk_table": (f"{w} SELECT chunk_id, doc_id, md5(text) AS text_md5, "
                        f"to_json({{'source_url': source_url, 'title': title}})::VARCHAR AS metadata, "
                        f"CAST({DIM} AS INTEGER) AS n_dims FROM chunks"),
        "chunk_refresh": (f"{w} SELECT chunk_id, doc_id, md5(text) AS text_md5, "
                          f"to_json({{'source_url': source_url, 'title': title}})::VARCHAR AS metadata, "
                          f"CAST({DIM} AS INTEGER) AS n_dims FROM chunks"),
        "corpus_scan": (f"{doc_ctes()}, last AS (SELECT 'crawled-docs/' || filename || '.md' AS key, "
                        f"arg_max(source_url, ordinal) AS source_url, arg_max(title, ordinal) AS title, "
                        f"arg_max('# ' || title || chr(10) || chr(10) || '**Source:** ' || source_url || chr(10) || "
                        f"'**Crawled:** ' || crawled_at || chr(10) || chr(10) || '---' || chr(10) || chr(10) || content "
                        f"|| chr(10), ordinal) AS body, max(ordinal) AS o FROM docs GROUP BY 1) "
                        f"SELECT key, CASE WHEN o % 7 = 0 THEN 'store://' || key ELSE source_url END AS source_url, "
                        f"CASE WHEN o % 7 = 0 THEN '' ELSE title END AS title, md5(body) AS body_md5 FROM last"),
    }
    q["file_corpus"] = q["corpus_scan"]
    return q
