"""Registered knowledge-base queries: chunks and vectors from ``documents``,
questions from ``benchmark``, vector search over ``embeddings`` and over
chunks, citations and grounding context.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TEST_CHUNKS, TEST_POLICY
from ..operators import blocks as B
from ..operators import documents as D
from ..operators import knowledge as K
from ..operators import quantised as Q
from ..session import scratch_path, stored_once
from ..sources import corpus as C
from ..sources import tables as T
from ..sources.keyed import refresh_chunks

CFG = TEST_CHUNKS
BUCKET = "corpus-bucket"
PREFIX = TEST_POLICY.key_prefix


def kb_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Stored documents: URL, title (first line, 60 characters), file key
    and object location of every row of ``documents``."""
    d = T.read_table(spark, sf, "documents")
    url = T.doc_url()
    title = F.substring(F.substring_index(F.col("text"), "\n", 1), 1, 60)
    return (d.select("doc_id", url.alias("source_url"), title.alias("title"), "text")
            .withColumn("filename", D.document_key(F.col("title"), F.col("source_url")))
            .withColumn("uri", F.concat(F.lit(f"s3://{BUCKET}/{PREFIX}"), F.col("filename"), F.lit(".md"))))


def kb_chunks(spark: SparkSession, sf: str, cfg=CFG) -> DataFrame:
    """Chunks with their sidecar attributes and embedding. The embedded text
    is the chunk text; attributes flagged for embedding are prefixed."""
    ch = K.chunk_documents(kb_documents(spark, sf), cfg)
    ch = ch.withColumn("metadata", F.to_json(F.struct("source_url", "title")))
    embed_text = F.concat_ws("\n", F.col("title"), F.col("text")) if cfg.include_title else F.col("text")
    return K.embed(ch.withColumn("_embed_text", embed_text), "_embed_text", cfg.dim).drop("_embed_text")


def questions(spark: SparkSession, sf: str, dim: int = CFG.dim) -> DataFrame:
    b = T.read_table(spark, sf, "benchmark").select(F.col("item_id").alias("q_id"), "text")
    return K.embed(b, "text", dim)


def knowledge_base(spark, sf) -> tuple[DataFrame, B.Index]:
    """Chunk table and its inverted index, built once per session and state of
    the ``documents`` files and read by every retrieval query."""
    def make():
        path = C.write_chunk_table(kb_chunks(spark, sf), scratch_path(spark, "chunk-table"))
        return path, B.build(spark.read.parquet(path), "lists", "chunk_id", "vector")
    path, index = stored_once(spark, "knowledge-base", T.table_path(sf, "documents"), make)
    return spark.read.parquet(path), index


def retrieved(spark, sf):
    """Top-5 chunks per benchmark question. The chunk table is read with
    column pruning: the search reads its index, texts are read to be shown."""
    chunks, index = knowledge_base(spark, sf)
    attributes = {c: F.get_json_object("metadata", f"$.{c}") for c in ("source_url", "title")}
    return K.retrieve(questions(spark, sf), chunks.withColumns(attributes), index=index)


def responses(spark, sf):
    """Citation responses built from the retrieval hits. The attribute
    shape varies with the rank so every form occurs: plain strings,
    ``{"stringValue"}`` objects, ``{"value"}`` objects, an empty object and
    missing attributes. References are grouped two per citation."""
    h = retrieved(spark, sf)
    r = F.col("rank")
    meta = (F.when(r == 1, F.to_json(F.struct("source_url", "title")))
            .when(r == 2, F.to_json(F.struct(F.struct(F.lit("STRING").alias("type"), F.col("source_url").alias("stringValue")).alias("source_url"),
                                             F.struct(F.col("title").alias("stringValue")).alias("title"))))
            .when(r == 3, F.to_json(F.struct(F.struct(F.col("source_url").alias("value")).alias("source_url"),
                                             F.struct(F.col("title").alias("value")).alias("title"))))
            .when(r == 4, F.to_json(F.struct(F.struct(F.lit(None).cast("string").alias("x")).alias("source_url"),
                                             F.col("title").alias("title"))))
            .otherwise(F.lit("{}")))
    refs = h.select("q_id", ((r - 1) / 2).cast("int").alias("citation_no"),
                    F.struct(r.alias("ref_rank"), F.col("uri"), meta.alias("metadata")).alias("ref"))
    per_c = refs.groupBy("q_id", "citation_no").agg(F.array_sort(F.collect_list("ref")).alias("refs"))
    per_q = per_c.groupBy("q_id").agg(F.array_sort(F.collect_list(F.struct("citation_no", "refs"))).alias("_c"))
    return per_q.select("q_id", F.transform("_c", lambda c: F.struct(
        F.transform(c["refs"], lambda x: F.struct(x["uri"].alias("uri"), x["metadata"].alias("metadata"))).alias("refs")
    )).alias("citations"))


def q_chunk_documents(spark, sf):
    ch = K.chunk_documents(kb_documents(spark, sf), CFG)
    return ch.select("chunk_id", "doc_id", "pos", "n_words", F.md5("text").alias("text_md5"))


def q_chunk_metadata(spark, sf):
    ch = K.chunk_documents(kb_documents(spark, sf), CFG)
    return ch.select("chunk_id", "doc_id", "uri", F.to_json(F.struct("source_url", "title")).alias("metadata"))


def q_embed_chunks(spark, sf):
    return K.sparse_weights(kb_chunks(spark, sf), "chunk_id")


def embeddings(spark, sf):
    return T.read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("c_id"), F.col("embedding").alias("vector"))


def q_vector_topk(spark, sf):
    hits, _ = B.topk(questions(spark, sf, 64), B.build(embeddings(spark, sf), "pivots"), 5)
    return hits.select(F.col("q_id").alias("item_id"), "rank", F.col("c_id").alias("vec_id"),
                       F.round("distance", 6).alias("distance"))


def q_vector_topk_ann(spark, sf):
    e, q = embeddings(spark, sf), questions(spark, sf, 64)
    hits, _ = Q.topk(q, Q.build(e), 5)
    # recall is the mean of ``in_exact`` over 5 x questions
    exact = K.vector_topk(q, e, 5).select("q_id", "c_id", F.lit(True).alias("in_exact"))
    return hits.join(exact, ["q_id", "c_id"], "left").select(
        F.col("q_id").alias("item_id"), "rank", F.col("c_id").alias("vec_id"),
        F.round("distance", 6).alias("distance"), F.coalesce("in_exact", F.lit(False)).alias("in_exact"))


def q_retrieve(spark, sf):
    h = retrieved(spark, sf)
    return h.select(F.col("q_id").alias("item_id"), "rank", "chunk_id", F.round("score", 6).alias("score"),
                    "snippet", "uri")


def q_citation_flatten(spark, sf):
    f = K.citation_flatten(responses(spark, sf))
    return f.select(F.col("q_id").alias("item_id"), "citation_no", "ref_no", "uri", "source_url", "title", "display")


def q_citation_dedupe(spark, sf):
    d = K.citation_dedupe(K.citation_flatten(responses(spark, sf)))
    return d.select(F.col("q_id").alias("item_id"), "source_no", "display", "title")


def q_citations(spark, sf):
    """End to end: question text -> retrieval -> citations -> unique
    sources, shown with web URL when the sidecar gave one."""
    d = K.citation_dedupe(K.citation_flatten(responses(spark, sf)))
    b = T.read_table(spark, sf, "benchmark").select(F.col("item_id").alias("q_id"), F.col("text").alias("question"))
    return d.join(b, "q_id").select(F.col("q_id").alias("item_id"), F.md5("question").alias("question_md5"),
                                    "source_no", "display", "title")


def q_rag_context(spark, sf):
    c = K.rag_context(retrieved(spark, sf))
    return c.select(F.col("q_id").alias("item_id"), F.md5("context").alias("context_md5"),
                    F.length("context").alias("context_length"), "n_chunks")


def q_answer_grounding(spark, sf):
    r = responses(spark, sf)
    g = K.answer_grounding(r, K.citation_flatten(r))
    return g.select(F.col("q_id").alias("item_id"), "n_citations", "n_refs", "n_sources")


def q_chunk_table(spark, sf):
    path = C.write_chunk_table(kb_chunks(spark, sf), scratch_path(spark, "chunk-table"))
    t = spark.read.parquet(path)
    return t.select("chunk_id", "doc_id", F.md5("text").alias("text_md5"), "metadata",
                    F.size("vector").alias("n_dims"))


def q_chunk_refresh(spark, sf):
    """The chunk table after two runs of the ingestion. Before the second one a
    tenth of the documents is new, a third has another text, and some, which
    have negative ids, are gone."""
    docs = kb_documents(spark, sf)
    i = F.col("doc_id")
    earlier = docs.filter(i % 10 != 9).withColumn("text", F.when(i % 3 == 0, F.concat(F.lit("old "), F.col("text")))
                                                  .otherwise(F.col("text")))
    gone = docs.filter(i % 20 == 0).withColumn("doc_id", -i - 1)
    root = scratch_path(spark, "chunk-refresh")
    for some in (earlier.unionByName(gone), docs):
        refresh_chunks(some, CFG, root)
    t = spark.read.parquet(f"{root}/chunks")
    return t.select("chunk_id", "doc_id", F.md5("text").alias("text_md5"), "metadata", F.size("vector").alias("n_dims"))


def _stored(spark, sf):
    """Rendered documents, the last write per object key, as an object store
    keeps it, and their sidecars; every seventh document has lost its sidecar."""
    from . import documents as P
    last = D.latest_document(D.rendered(P._docs(spark, sf), P.POLICY), key="key").drop("writes")
    return last, D.sidecar(last).filter(F.pmod("ordinal", F.lit(7)) != 0)


def q_corpus_scan(spark, sf):
    """Store the documents and sidecars as tables, then scan them back."""
    root = C.write_store(*_stored(spark, sf), scratch_path(spark, "doc-store"))
    s = C.corpus_scan(spark, root, PREFIX)
    return s.select("key", "source_url", "title", F.md5("body").alias("body_md5"))


def q_file_corpus(spark, sf):
    """The same as one file per document with its sidecar beside it."""
    root = C.write_files(*_stored(spark, sf), scratch_path(spark, "doc-files"))
    s = C.file_corpus(spark, root, PREFIX)
    return s.select("key", "source_url", "title", F.md5("body").alias("body_md5"))
