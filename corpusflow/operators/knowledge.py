"""Knowledge base: chunks, embeddings, nearest-neighbour search, retrieval,
citations and grounding context.

* Chunking and token bucketing are native array expressions (no shuffle).
* The dense vector of a chunk is built by an Arrow UDF: tokens in, normalised
  float vector out, numpy does the counting. It is the pluggable embedder hook.
* Exact top-k never forms question x chunk pairs as rows: the question side
  is broadcast after a size check (batched when it is too large), every
  corpus partition keeps a running top-k per question in numpy, and a final
  ``row_number() <= k`` (planned as a partial + final group limit) merges
  the per-partition candidates.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RETRIEVE_K, SNIPPET_CHARS, ChunkConfig
from ..functions.text import PY_SPACE
from ..session import scratch_path, ship_package, spread

# Question side broadcast per pass; larger question sets run in batches.
MAX_BROADCAST_BYTES = 64 << 20
# Distinct tokens whose bucket is remembered per task, and tokens counted at once.
MEMO_LIMIT = 1 << 17
SLICE_TOKENS = 1 << 19
# Entries of a dense matrix built per slice inside a task (float64: 32 MiB).
MATRIX_BUDGET = 4 << 20


# ---- chunking ------------------------------------------------------------------

def words(text: Column) -> Column:
    """Python ``str.split()``: runs of Unicode whitespace separate words."""
    return F.filter(F.split(text, f"[{PY_SPACE}]+"), lambda w: w != "")


def has_words(text: Column) -> Column:
    """Whether ``words`` finds any; reads up to the first one."""
    return text.rlike(f"[^{PY_SPACE}]")


def chunk_documents(docs: DataFrame, cfg: ChunkConfig, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Split each document into windows of ``cfg.size`` words that overlap
    by ``cfg.overlap``; the last, shorter window is kept. Other columns of
    ``docs`` are carried to every chunk (the chunk-to-document attribute
    join happens for free, without a shuffle).

    Adds ``chunk_id, pos, text, n_words`` (``text`` is the chunk text).
    """
    step = cfg.size - cfg.overlap
    w = words(F.col(text_col))
    n = F.size("_w")
    n_chunks = F.when(n <= cfg.size, F.lit(1)).otherwise(
        F.ceil((n - cfg.size) / F.lit(step)).cast("int") + 1)
    texts = F.transform(F.sequence(F.lit(0), n_chunks - 1),
                        lambda p: F.struct(F.array_join(F.slice("_w", p * step + 1, cfg.size), " ").alias("text"),
                                           F.least(F.lit(cfg.size), n - p * step).alias("n_words")))
    carry = [c for c in docs.columns if c != text_col]
    # asked of the text: a filter on the words would split every text once more
    return (spread(docs).filter(has_words(F.col(text_col))).withColumn("_w", w)
            .select(*carry, F.posexplode(texts).alias("pos", "_c"))
            .select(*carry, "pos", "_c.text", "_c.n_words")
            .withColumn("chunk_id", F.concat(F.col(id_col).cast("string"), F.lit("-"), F.col("pos").cast("string"))))


# ---- embedding -----------------------------------------------------------------

def raw_tokens(text: Column) -> Column:
    """Lower-cased text split on runs of non letter/number characters (empty
    pieces at the ends are dropped by the embedder)."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def token_bucket(token: str, dim: int) -> int:
    """Hash bucket of a token: first 32 bits of its md5, modulo ``dim``."""
    return int.from_bytes(hashlib.md5(token.encode("utf-8")).digest()[:4], "big") % dim


def _bag_to_vectors(dim: int):
    """Arrow function: token lists -> L2-normalised bucket counts.

    Lists are taken in slices of about SLICE_TOKENS tokens, and of as many rows
    as keep the dense count matrix within MATRIX_BUDGET entries; the distinct
    tokens of a slice are hashed, those met before come from a bounded memo.
    What a worker holds depends on neither the rows nor the vocabulary."""
    def vectors(col, memo):
        n = len(col)
        offsets = np.asarray(col.offsets, dtype=np.int64)
        rows = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
        coded = pc.dictionary_encode(col.flatten())
        names = coded.dictionary.to_pylist()
        if len(memo) > MEMO_LIMIT:
            memo.clear()
        for u in names:
            if u not in memo:
                memo[u] = token_bucket(u, dim)
        # null and empty tokens count nowhere
        ub = np.asarray([memo[u] if u else -1 for u in names] + [-1], dtype=np.int64)
        buckets = ub[np.asarray(pc.fill_null(coded.indices, len(names)), dtype=np.int64)]
        keep = buckets >= 0
        mat = np.bincount(rows[keep] * dim + buckets[keep], minlength=n * dim).astype(np.float64).reshape(n, dim)
        norm = np.sqrt((mat * mat).sum(axis=1))
        norm[norm == 0] = 1.0
        vec = (mat / norm[:, None]).astype(np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32)), pa.array(vec.reshape(-1)))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo: dict[str, int] = {}
        most = max(64, MATRIX_BUDGET // dim)
        for whole in batches:
            offsets = np.asarray(whole.offsets, dtype=np.int64)
            parts, at = [], 0
            while at < len(whole):
                upto = int(np.searchsorted(offsets, offsets[at] + SLICE_TOKENS, side="right")) - 1
                upto = min(max(upto, at + 1), at + most, len(whole))
                parts.append(vectors(whole.slice(at, upto - at), memo))
                at = upto
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))
    return F.arrow_udf(run, "array<float>")


def embed(df: DataFrame, text_col: str, dim: int, out_col: str = "vector", embedder=None) -> DataFrame:
    """Embedding of a text column, ``ARRAY<FLOAT>`` of width ``dim``.

    ``embedder(texts: list[str], dim: int) -> array (rows x dim)`` is called
    per bounded slice of an Arrow batch. Without one: hashed bag of words,
    L2-normalised; tokenising runs in the JVM, hashing of distinct tokens and
    counting per Arrow batch. Only the tokens travel to Python, the other
    columns of ``df`` stay in the JVM."""
    ship_package(df.sparkSession)
    if embedder is not None:
        return df.withColumn(out_col, _embed_with(embedder, dim)(F.col(text_col)))
    return df.withColumn(out_col, _bag_to_vectors(dim)(raw_tokens(F.col(text_col))))


def _embed_with(embedder, dim: int):
    step = max(1, MATRIX_BUDGET // dim)

    @F.arrow_udf("array<float>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            parts = [np.asarray(embedder(texts[i:i + step], dim), dtype=np.float32).reshape(-1, dim)
                     for i in range(0, len(texts), step)]
            flat = np.concatenate(parts).ravel() if parts else np.zeros(0, np.float32)
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, dim, dtype=np.int32)), pa.array(flat))
    return vectors


def sparse_weights(df: DataFrame, id_col: str, vec_col: str = "vector") -> DataFrame:
    """Non-zero entries ``(id, bucket, weight)`` of dense vectors."""
    return (df.select(id_col, F.posexplode(vec_col).alias("bucket", "w"))
            .filter(F.col("w") != 0)
            .select(id_col, "bucket", F.round(F.col("w").cast("double"), 6).alias("weight")))


# ---- exact top-k -----------------------------------------------------------------

def _keep_best(best_q, best_d, best_i, qi, d, ids, k):
    """Running best k per question (index) after adding candidates; ties go
    to the smaller id."""
    if best_q is not None:
        qi, d, ids = np.concatenate([best_q, qi]), np.concatenate([best_d, d]), np.concatenate([best_i, ids])
    order = np.lexsort((ids, d, qi))
    qi, d, ids = qi[order], d[order], ids[order]
    starts = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1]])
    rank = np.arange(len(qi)) - np.repeat(starts, np.diff(np.r_[starts, len(qi)]))
    keep = rank < k
    return qi[keep], d[keep], ids[keep]


def _topk_partition(q_ids, q_mat, k, c_id_col="c_id", c_vec_col="vector"):
    """Arrow batch function: running top-k per question over one corpus
    partition, vectorised across questions. Corpus rows are taken in slices
    so the question x slice distance matrix stays within MATRIX_BUDGET.
    Candidates come from the expanded form of the squared distance; the
    k-th boundary is widened by a tolerance and every candidate is
    re-measured exactly, so ties are resolved by id."""
    def run(batches):
        m, dim = q_mat.shape
        qn = (q_mat * q_mat).sum(axis=1)
        step = max(64, MATRIX_BUDGET // max(m, 1))
        best_q = best_d = best_i = None
        for rb in batches:
            if rb.num_rows == 0:
                continue
            ids_all = rb.column(rb.schema.get_field_index(c_id_col)).to_numpy(zero_copy_only=False)
            if ids_all.dtype == object:
                ids_all = ids_all.astype(str)
            c_all = np.asarray(rb.column(rb.schema.get_field_index(c_vec_col)).flatten(),
                               dtype=np.float64).reshape(-1, dim)
            for off in range(0, c_all.shape[0], step):
                c, ids = c_all[off:off + step], ids_all[off:off + step]
                approx = qn[:, None] + (c * c).sum(axis=1)[None, :] - 2.0 * (q_mat @ c.T)
                kk = min(k, c.shape[0])
                kth = np.partition(approx, kk - 1, axis=1)[:, kk - 1]
                qi, ci = np.nonzero(approx <= (kth + 1e-7 * (1.0 + np.abs(kth)))[:, None])
                diff = c[ci] - q_mat[qi]
                d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                cand_i = ids[ci]
                best_q, best_d, best_i = _keep_best(best_q, best_d, best_i, qi, d, cand_i, k)
        if best_q is not None and len(best_q):
            yield pa.RecordBatch.from_arrays(
                [pa.array([q_ids[x] for x in best_q.tolist()]), pa.array(best_i.tolist()),
                 pa.array(best_d, pa.float64())], names=["q_id", "c_id", "distance"])
    return run


def question_batches(questions: DataFrame, q_id: str, q_vec: str,
                     max_broadcast_bytes: int = MAX_BROADCAST_BYTES):
    """Yield ``(ids, matrix)`` batches of the question side, each at most
    ``max_broadcast_bytes`` (checked on count x width before collecting);
    batches are hash slices of the question ids."""
    stats = questions.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(q_vec)).alias("d")).first()
    n_q, dim = int(stats["n"]), int(stats["d"] or 0)
    if n_q == 0:
        return
    n_batches = max(1, math.ceil(n_q * max(dim, 1) * 8 / max_broadcast_bytes))
    for b in range(n_batches):
        qb = questions.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("vector"))
        if n_batches > 1:
            qb = qb.filter(F.pmod(F.xxhash64("q_id"), F.lit(n_batches)) == b)
        rows = qb.collect()  # bounded by the size check above
        if rows:
            yield [r["q_id"] for r in rows], np.asarray([r["vector"] for r in rows], dtype=np.float64)


def vector_topk(questions: DataFrame, corpus: DataFrame, k: int = RETRIEVE_K,
                q_id: str = "q_id", q_vec: str = "vector", c_id: str = "c_id",
                c_vec: str = "vector", max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Exact k nearest corpus rows (L2) per question: ``(q_id, rank, c_id,
    distance)``; ties broken by corpus id.

    The question side is broadcast only after a size check (rows x width x
    8 bytes); above the limit it is split into hash blocks, each broadcast
    in its own pass over the corpus, written and released before the next.
    No question x corpus pair becomes a row.
    """
    q_type, c_type = questions.schema[q_id].dataType, corpus.schema[c_id].dataType
    cor = corpus.select(F.col(c_id).alias("c_id"), F.col(c_vec).alias("vector"))
    return _by_blocks(questions, cor, k, q_id, q_vec, q_type, c_type, max_broadcast_bytes,
                      lambda ids, mat: (ids, mat), lambda v: _topk_partition(v[0], v[1], k))


def _by_blocks(questions, corpus, k, q_id, q_vec, q_type, c_type, max_broadcast_bytes, payload, function):
    """Top-k of the questions, one bounded block after another: the question
    vectors are stored once, and a block's result is written and its
    broadcast released before the next block is read."""
    spark = questions.sparkSession
    ship_package(spark)
    schema = T.StructType([T.StructField("q_id", q_type), T.StructField("c_id", c_type),
                           T.StructField("distance", T.DoubleType())])
    out_schema = T.StructType([T.StructField("q_id", q_type), T.StructField("rank", T.IntegerType()),
                               T.StructField("c_id", c_type), T.StructField("distance", T.DoubleType())])
    asked, found = scratch_path(spark, "questions"), scratch_path(spark, "top-k")
    questions.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("vector")).write.parquet(asked)
    stored = spark.read.parquet(asked)
    w = Window.partitionBy("q_id").orderBy("distance", "c_id")
    some = False
    for ids, mat in question_batches(stored, "q_id", "vector", max_broadcast_bytes):
        bc = spark.sparkContext.broadcast(payload(ids, mat))

        def fn(batches, bc=bc):
            yield from function(bc.value)(batches)
        cand = corpus.mapInArrow(fn, schema)
        best = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        best.select("q_id", "rank", "c_id", "distance").write.mode("append").parquet(found)
        bc.destroy()
        some = True
    return spark.read.schema(out_schema).parquet(found) if some else spark.createDataFrame([], out_schema)


def l2_score(distance: Column) -> Column:
    """Similarity reported for an L2 index: 1 / (1 + d^2)."""
    return F.lit(1.0) / (F.lit(1.0) + distance * distance)


# ---- approximate top-k (inverted file) ----------------------------------------

#: Vectors the centroids are fitted on, at most.
CENTROID_SAMPLE = 20_000
MAX_LISTS = 4096
#: Recall the default number of probes reaches on so many questions.
ANN_RECALL, ANN_TRIED = 0.95, 256


def ivf_index(corpus: DataFrame, n_lists: int | None = None, seed: int = 7, c_id: str = "c_id",
              c_vec: str = "vector"):
    """Centroids (ndarray) and the corpus with each row's nearest ``list_id``.

    Centroids are fitted by k-means on at most CENTROID_SAMPLE rows, taken in
    the order of a hash of their id; every row is assigned. By default there
    are about as many lists as the square root of the corpus, so a list grows
    with the square root too."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    n = n_lists or min(MAX_LISTS, max(8, math.isqrt(corpus.count())))
    sample = corpus.orderBy(F.xxhash64(c_id)).limit(CENTROID_SAMPLE).select(array_to_vector(F.col(c_vec)).alias("f"))
    model = KMeans(k=n, seed=seed, featuresCol="f", maxIter=10).fit(sample.checkpoint())
    cents = np.asarray(model.clusterCenters(), dtype=np.float64)

    @F.arrow_udf("int")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        norms = (cents * cents).sum(axis=1)
        for batch in batches:
            x = np.asarray(batch.flatten(), dtype=np.float64).reshape(-1, cents.shape[1])
            out = [np.argmin(norms - 2.0 * (x[i:i + 4096] @ cents.T), axis=1) for i in range(0, len(x), 4096)]
            yield pa.array(np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32))

    return cents, corpus.withColumn("list_id", nearest(F.col(c_vec)))


def _topk_lists(q_ids, q_mat, probes, k):
    """Arrow batch function over (c_id, vector, list_id): for the rows of each
    list, only the questions that probe it; a running top-k per question."""
    asking: dict[int, list[int]] = {}
    for i, row in enumerate(probes.tolist()):
        for lst in row:
            asking.setdefault(lst, []).append(i)

    def run(batches):
        best = (None, None, None)
        for rb in batches:
            if not rb.num_rows:
                continue
            ids = rb.column(0).to_numpy(zero_copy_only=False)
            ids = ids.astype(str) if ids.dtype == object else ids
            x = np.asarray(rb.column(1).flatten(), dtype=np.float64).reshape(rb.num_rows, -1)
            lists = rb.column(2).to_numpy(zero_copy_only=False)
            order = np.argsort(lists, kind="stable")
            cuts = np.flatnonzero(np.diff(lists[order])) + 1
            for rows in np.split(order, cuts):
                qs = np.asarray(asking.get(int(lists[rows[0]]), []), dtype=np.int64)
                for i in range(0, len(qs), max(1, MATRIX_BUDGET // len(rows))):
                    q = qs[i:i + max(1, MATRIX_BUDGET // len(rows))]
                    d2 = ((q_mat[q] ** 2).sum(axis=1)[:, None] + (x[rows] ** 2).sum(axis=1)[None, :]
                          - 2.0 * (q_mat[q] @ x[rows].T))
                    kth = np.partition(d2, min(k, len(rows)) - 1, axis=1)[:, min(k, len(rows)) - 1]
                    a, b = np.nonzero(d2 <= (kth + 1e-7 * (1.0 + np.abs(kth)))[:, None])
                    diff = x[rows[b]] - q_mat[q[a]]
                    best = _keep_best(*best, q[a], np.sqrt(np.einsum("ij,ij->i", diff, diff)), ids[rows[b]], k)
        if best[0] is not None and len(best[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([q_ids[i] for i in best[0].tolist()]), pa.array(best[2].tolist()),
                 pa.array(best[1], pa.float64())], names=["q_id", "c_id", "distance"])
    return run


def probes_needed(questions: DataFrame, assigned: DataFrame, cents: np.ndarray, k: int, q_id: str, q_vec: str,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> int:
    """Least number of nearest lists that hold ANN_RECALL of the exact top-k of
    at most ANN_TRIED questions, taken in the order of a hash of their id."""
    spark = questions.sparkSession
    path = scratch_path(spark, "ann-tried")
    (questions.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("vector"))
     .orderBy(F.xxhash64("q_id")).limit(ANN_TRIED).write.parquet(path))
    tried = spark.read.parquet(path)
    exact = vector_topk(tried, assigned.select("c_id", "vector"), k, max_broadcast_bytes=max_broadcast_bytes)
    # at most ANN_TRIED x k rows
    hits = (assigned.select("c_id", "list_id").join(F.broadcast(exact.select("q_id", "c_id")), "c_id")
            .join(F.broadcast(tried), "q_id").select("vector", "list_id").collect())
    if not hits:
        return 1
    to = (cents * cents).sum(axis=1) - 2.0 * (np.asarray([h["vector"] for h in hits], dtype=np.float64) @ cents.T)
    own = to[np.arange(len(hits)), [h["list_id"] for h in hits]]
    ranks = np.sort((to <= own[:, None]).sum(axis=1))
    return int(ranks[math.ceil(ANN_RECALL * len(ranks)) - 1])


def vector_topk_ann(questions: DataFrame, corpus: DataFrame, k: int = RETRIEVE_K, n_lists: int | None = None,
                    n_probe: int | None = None, q_id: str = "q_id", q_vec: str = "vector", c_id: str = "c_id",
                    c_vec: str = "vector", seed: int = 7,
                    max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Inverted-file approximate search: each question is compared with the
    rows of its ``n_probe`` nearest lists; by default as many as ANN_TRIED of the
    questions need to find ANN_RECALL of their exact top-k (one scan of the
    corpus for those questions). Lists are a column, not a partitioning, so a list holding a third of the corpus is still spread over
    all tasks. Output and block-wise question side as ``vector_topk``."""
    cents, assigned = ivf_index(corpus.select(F.col(c_id).alias("c_id"), F.col(c_vec).alias("vector")),
                                n_lists, seed)
    if n_probe is None:
        path = scratch_path(corpus.sparkSession, "ivf-lists")
        assigned.write.parquet(path)
        assigned = corpus.sparkSession.read.parquet(path)
        n_probe = probes_needed(questions, assigned, cents, k, q_id, q_vec, max_broadcast_bytes)

    def payload(ids, mat):
        step = max(1, MATRIX_BUDGET // len(cents))
        near = [np.argsort((cents * cents).sum(axis=1) - 2.0 * (mat[i:i + step] @ cents.T), axis=1)[:, :n_probe]
                for i in range(0, len(mat), step)]
        return ids, mat, np.concatenate(near)

    return _by_blocks(questions, assigned.select("c_id", "vector", "list_id"), k, q_id, q_vec,
                      questions.schema[q_id].dataType, corpus.schema[c_id].dataType, max_broadcast_bytes,
                      payload, lambda v: _topk_lists(*v, k))


# ---- retrieval, citations, context ----------------------------------------------

def retrieve(questions: DataFrame, chunks: DataFrame, k: int = RETRIEVE_K, index=None) -> DataFrame:
    """Top-k chunks per question with score, snippet and source location.

    ``questions(q_id, vector)``, ``chunks(chunk_id, vector, text, uri, ...)``.
    Missing score -> 0, missing text -> '', missing uri -> ''. ``index`` is the
    inverted index over the chunk vectors (``blocks.build``), made here if
    there is none yet.
    """
    from . import blocks
    if index is None:
        index = blocks.build(chunks, "lists", "chunk_id", "vector")
    hits, _ = blocks.topk(questions, index, k)
    meta = chunks.drop("vector").withColumnRenamed("chunk_id", "c_id")
    # every hit names an existing chunk, so an inner join is exact; the hit
    # side (k rows per question) is the small, broadcastable build side
    return (meta.join(hits, "c_id")
            .select("q_id", "rank", F.col("c_id").alias("chunk_id"), "distance",
                    F.coalesce(l2_score(F.col("distance")), F.lit(0.0)).alias("score"),
                    F.substring(F.coalesce(F.col("text"), F.lit("")), 1, SNIPPET_CHARS).alias("snippet"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"),
                    F.coalesce(F.col("uri"), F.lit("")).alias("uri"),
                    *[c for c in ("source_url", "title", "doc_id", "metadata") if c in meta.columns]))


def _meta_value(v: Column, key: str) -> Column:
    """Attribute value that may be a string or an object: an object yields
    its ``stringValue`` (if present), else ``value``, else ''; a string
    yields itself; missing yields ''."""
    path = f"$.{key}"
    is_obj = F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")).startswith("OBJECT"),
                        F.lit(False))
    sv = F.try_variant_get(v, f"{path}.stringValue", "string")
    vv = F.try_variant_get(v, f"{path}.value", "string")
    has_sv = F.try_variant_get(v, f"{path}.stringValue", "variant").isNotNull()
    obj_val = F.when(has_sv, F.coalesce(sv, F.lit(""))).otherwise(F.coalesce(vv, F.lit("")))
    return F.when(is_obj, obj_val).otherwise(F.coalesce(F.try_variant_get(v, path, "string"), F.lit("")))


def citation_flatten(responses: DataFrame, q_col: str = "q_id") -> DataFrame:
    """``responses(q_id, citations ARRAY<STRUCT<refs: ARRAY<STRUCT<uri,
    metadata>>>>)`` -> one row per reference ``(q_id, citation_no, ref_no,
    uri, source_url, title, display)``; display is the source URL, else the
    stored object URI."""
    c = responses.select(q_col, F.posexplode("citations").alias("citation_no", "c"))
    r = c.select(q_col, "citation_no", F.posexplode("c.refs").alias("ref_no", "r"))
    v = F.try_parse_json(F.coalesce(F.col("r.metadata"), F.lit("{}")))
    out = r.select(q_col, "citation_no", "ref_no", F.coalesce(F.col("r.uri"), F.lit("")).alias("uri"),
                   _meta_value(v, "source_url").alias("source_url"), _meta_value(v, "title").alias("title"))
    return out.withColumn("display", F.when(F.col("source_url") != "", F.col("source_url"))
                          .otherwise(F.col("uri")))


def citation_dedupe(flat: DataFrame, q_col: str = "q_id") -> DataFrame:
    """Unique display per question in first-seen order, with the first-seen
    title: ``(q_id, source_no, display, title)``. The per (question,
    display) ``min_by`` is partially aggregated."""
    pos = F.struct("citation_no", "ref_no")
    first = (flat.groupBy(q_col, "display").agg(F.min(pos).alias("_first"),
                                                F.min_by("title", pos).alias("title")))
    w = Window.partitionBy(q_col).orderBy("_first")
    return first.select(q_col, F.row_number().over(w).alias("source_no"), "display", "title")


def rag_context(hits: DataFrame, q_col: str = "q_id", sep: str = "\n\n") -> DataFrame:
    """Grounding context per question: retrieved texts joined in rank order.
    One group per question holds at most k rows."""
    g = hits.groupBy(q_col).agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("_h"))
    return g.select(q_col, F.array_join(F.transform("_h", lambda h: h["text"]), sep).alias("context"),
                    F.size("_h").alias("n_chunks"))


def answer_grounding(responses: DataFrame, flat: DataFrame, q_col: str = "q_id") -> DataFrame:
    """Per question: citations, references, and distinct sources."""
    a = responses.select(q_col, F.size("citations").alias("n_citations"))
    b = flat.groupBy(q_col).agg(F.count(F.lit(1)).alias("n_refs"),
                               F.count_distinct("display").alias("n_sources"))
    return a.join(b, q_col, "left").select(q_col, "n_citations", F.coalesce("n_refs", F.lit(0)).alias("n_refs"),
                                           F.coalesce("n_sources", F.lit(0)).alias("n_sources"))
