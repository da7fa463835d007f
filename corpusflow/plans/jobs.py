"""End-to-end jobs: crawl a URL list into a knowledge base, and answer a
batch of questions from it.

``crawl_job`` is the Spark form of one crawl request: payloads -> seeds ->
crawl session -> table-of-contents follow-up level by level -> stored
documents -> object store + sidecars -> chunk table. The follow-up order
is breadth first (depth, parent order, link position). A level works on its
own rows; the visited set and the page budget carry across levels as state.

``ask_job`` embeds questions, searches the chunk table, and returns the
retrieved chunks, de-duplicated sources and the grounding context.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RETRIEVE_K, ChunkConfig, CrawlPolicy
from ..operators import documents as D
from ..operators import knowledge as K
from ..operators.crawl import PageTable, crawl_levels
from ..operators.reports import run_summary
from ..operators.seeds import seed_urls
from ..operators.session import ordinals
from ..session import scratch_path
from ..sources import corpus as C


@dataclass
class CrawlResult:
    session: DataFrame      # one row per fetch attempt with verdict and kind
    documents: DataFrame    # stored documents (store log, duplicates kept)
    receipts: DataFrame
    summary: DataFrame
    store_root: str
    chunk_path: str | None   # None when nothing was stored


def crawl_job(spark: SparkSession, payloads: DataFrame, snapshot: DataFrame, policy: CrawlPolicy,
              crawled_at: str, robots: DataFrame | None = None, chunk_cfg: ChunkConfig = ChunkConfig(),
              store_root: str | None = None) -> CrawlResult:
    """Crawl request -> knowledge base. ``payloads(payload_id, payload)``
    are request JSON texts; ``snapshot`` is the captured fetch log with the
    extracted page (see ``plans.crawl.snapshot``)."""
    # the snapshot is stored by URL once, each level reads what it can hit; the
    # session is read again with column pruning by what follows
    pages = PageTable.write(snapshot)
    seeds = ordinals(seed_urls(payloads).filter(F.col("url").isNotNull()), "payload_id", "pos").select("ordinal", "url")
    session = crawl_levels(seeds, pages, policy, robots)
    stored = session.filter((F.col("verdict") == "ok") & (F.col("kind") == "ok"))
    requests = stored.select("ordinal", F.col("fetch_url").alias("url"), "title",
                             F.lit("").alias("content"), F.lit("").alias("metadata"))
    cache = session.filter("new_visit").select(F.col("fetch_url").alias("url"), "content")
    docs = D.document_rows(D.document_content(requests, cache), crawled_at)
    objs = D.rendered(docs, policy)
    receipts = D.store_receipt(objs, policy)
    last = D.latest_document(objs, key="key").drop("writes")
    root = store_root or scratch_path(spark, "kb-store")
    C.write_store(last, D.sidecar(last), root)
    latest_docs = D.latest_document(docs).drop("writes")
    kb = latest_docs.select(F.col("ordinal").alias("doc_id"), "source_url", "title", F.col("content").alias("text"),
                            F.concat(F.lit(policy.key_prefix), F.col("filename"),
                                     F.lit(".md" if policy.output_format == "markdown" else ".json")).alias("uri"))
    chunk_path = None
    if not kb.isEmpty():   # ingestion runs only when documents were stored
        chunks = K.chunk_documents(kb, chunk_cfg).withColumn("metadata", F.to_json(F.struct("source_url", "title")))
        chunk_path = C.write_chunk_table(K.embed(chunks, "text", chunk_cfg.dim), root)
    return CrawlResult(session, docs, receipts, run_summary(session), root, chunk_path)


@dataclass
class Answer:
    hits: DataFrame      # (q_id, rank, chunk_id, distance, score, snippet, text, uri, ...)
    sources: DataFrame   # (q_id, source_no, display, title)
    context: DataFrame   # (q_id, context, n_chunks)


def ask_job(spark: SparkSession, questions: DataFrame, chunk_path: str, dim: int,
            k: int = RETRIEVE_K) -> Answer:
    """``questions(q_id, text)`` -> retrieval over the chunk table, sources
    shown by web URL (from the chunk metadata) else by object location, and
    the grounding context."""
    chunks = spark.read.parquet(chunk_path)
    hits = K.retrieve(K.embed(questions, "text", dim), chunks, k)
    refs = hits.select("q_id", (F.col("rank") - 1).alias("citation_no"),
                       F.struct(F.col("uri"), F.col("metadata")).alias("ref"))
    responses = (refs.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct("citation_no", "ref"))).alias("_c"))
                 .select("q_id", F.transform("_c", lambda c: F.struct(F.array(c["ref"]).alias("refs")))
                         .alias("citations")))
    sources = K.citation_dedupe(K.citation_flatten(responses))
    return Answer(hits, sources, K.rag_context(hits))
