"""Approximate nearest rows with product-quantised codes.

The dimensions are dealt into ``parts``; each part has a codebook of at most
256 centroids, fitted on at most ``FIT_ROWS`` rows (in the order of a hash of the
id). A row's code is one byte a part. A search reads the codes only: a
question's distance to a code is the sum of one table entry a part. The rows of
the best codes, the shortlist, are fetched and measured exactly.

How long the shortlist must be is measured: for at most ``TRIED`` questions the
exact neighbours are found, and the places they take in the order of the codes
say which length holds ``RECALL`` of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RETRIEVE_K
from ..session import scratch_path, ship_package
from .knowledge import MATRIX_BUDGET, MAX_BROADCAST_BYTES, _keep_best, question_batches, vector_topk

#: Rows the codebooks are fitted on, rounds of fitting, dimensions a part.
FIT_ROWS, FIT_ROUNDS, PART_DIMS = 20_000, 8, 2
RECALL, TRIED = 0.95, 256
#: The shortlist is this much longer than the tried questions need.
SPARE = 1.25


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    norms = (centres * centres).sum(axis=1)
    step = max(1, MATRIX_BUDGET // len(centres))
    return np.concatenate([np.argmin(norms - 2.0 * (x[i:i + step] @ centres.T), axis=1)
                           for i in range(0, len(x), step)]) if len(x) else np.zeros(0, np.int64)


def _fitted(x: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centres of the rows of ``x``; a centre left alone goes to a row."""
    centres = x[rng.choice(len(x), size=min(size, len(x)), replace=False)].copy()
    for _ in range(FIT_ROUNDS):
        own = _nearest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        for d in range(x.shape[1]):
            total = np.bincount(own, x[:, d], minlength=len(centres))
            centres[:, d] = np.where(n > 0, total / np.maximum(n, 1), centres[:, d])
        empty = np.flatnonzero(n == 0)
        centres[empty] = x[rng.choice(len(x), size=len(empty))]
    return centres


@dataclass
class Codes:
    """Stored ``(c_id, vector, code)`` and the codebooks, one a part."""
    path: str
    books: list[np.ndarray]
    starts: list[int]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of every question's parts to every centroid:
        questions x parts x 256."""
        out = np.full((len(q), len(self.books), 256), np.inf)
        for m, (book, at) in enumerate(zip(self.books, self.starts, strict=True)):
            part = q[:, at:at + book.shape[1]]
            out[:, m, :len(book)] = ((part[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        return out


def build(corpus: DataFrame, c_id: str = "c_id", c_vec: str = "vector", seed: int = 7) -> Codes:
    """Fit the codebooks on a bounded sample and code every row."""
    spark = corpus.sparkSession
    ship_package(spark)
    rows = corpus.select(F.col(c_id).alias("c_id"), F.col(c_vec).alias("vector")).filter("vector is not null")
    sample = rows.orderBy(F.xxhash64("c_id"), "c_id").limit(FIT_ROWS).select("vector").collect()
    x = np.asarray([r[0] for r in sample], dtype=np.float64)
    rng = np.random.default_rng(seed)
    starts = list(range(0, x.shape[1], PART_DIMS)) if len(x) else []
    books = [_fitted(x[:, at:at + PART_DIMS], 256, rng) for at in starts]

    @F.arrow_udf("binary")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            v = np.asarray(batch.flatten(), dtype=np.float64).reshape(len(batch), -1)
            own = np.stack([_nearest(v[:, at:at + b.shape[1]], b) for b, at in zip(books, starts, strict=True)], axis=1)
            yield pa.array([row.tobytes() for row in own.astype(np.uint8)], pa.binary())
    path = scratch_path(spark, "pq-codes")
    (rows.withColumn("code", code("vector")) if books else rows.withColumn("code", F.lit(None).cast("binary"))).write.parquet(path)
    return Codes(path, books, starts)


def _codes(rb: pa.RecordBatch, parts: int) -> np.ndarray:
    raw = b"".join(rb.column(rb.schema.get_field_index("code")).to_pylist())
    return np.frombuffer(raw, dtype=np.uint8).reshape(-1, parts)


def _scored(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Distance of every question to every code."""
    out = np.zeros((len(tables), len(codes)))
    for m in range(codes.shape[1]):
        out += tables[:, m, :][:, codes[:, m]]
    return out


def _shortlist(tables: np.ndarray, length: int):
    """Arrow batch function over (c_id, code): the best ``length`` codes of
    every question in a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = (None, None, None), None
        for rb in batches:
            if not rb.num_rows:
                continue
            kind = rb.column(0).type
            ids = rb.column(0).to_numpy(zero_copy_only=False)
            ids = ids.astype(str) if ids.dtype == object else ids
            codes = _codes(rb, tables.shape[1])
            step = max(1, MATRIX_BUDGET // len(codes))
            for i in range(0, len(tables), step):
                d = _scored(tables[i:i + step], codes)
                kk = min(length, len(codes))
                near = np.argpartition(d, kk - 1, axis=1)[:, :kk]
                # codes that tie with the last one come along
                q, r = np.nonzero(d <= np.take_along_axis(d, near, 1).max(axis=1)[:, None])
                best = _keep_best(*best, q + i, d[q, r], ids[r], length)
        if best[0] is not None:
            yield pa.RecordBatch.from_arrays([pa.array(best[0].astype(np.int32)), pa.array(best[2].tolist(), kind),
                                              pa.array(best[1])], ["q", "c_id", "guess"])
    return run


def _ranks(tables: np.ndarray, own: np.ndarray, of: np.ndarray):
    """Arrow batch function over (c_id, code): how many codes of a partition
    are at most as far from question ``of[i]`` as ``own[i]``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(own), dtype=np.int64)
        for rb in batches:
            if not rb.num_rows:
                continue
            codes = _codes(rb, tables.shape[1])
            step = max(1, MATRIX_BUDGET // max(1, len(tables)))
            for i in range(0, len(codes), step):
                d = _scored(tables, codes[i:i + step])
                for j in range(len(own)):
                    n[j] += int((d[of[j]] <= own[j] + 1e-9).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own))), pa.array(n)], ["hit", "n"])
    return run


def shortlist_needed(questions: DataFrame, codes: Codes, k: int, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> int:
    """Length of the shortlist that holds RECALL of the exact neighbours of at
    most TRIED questions, taken in the order of a hash of their id."""
    spark = questions.sparkSession
    path = scratch_path(spark, "pq-tried")
    questions.orderBy(F.xxhash64("q_id"), "q_id").limit(TRIED).write.parquet(path)
    tried, table = spark.read.parquet(path), spark.read.parquet(codes.path)
    exact = vector_topk(tried, table.select("c_id", "vector"), k, max_broadcast_bytes=max_broadcast_bytes)
    # at most TRIED questions with k neighbours each
    hits = (table.select("c_id", "code").join(F.broadcast(exact.select("q_id", "c_id")), "c_id")
            .join(F.broadcast(tried), "q_id").select("q_id", "vector", "code").collect())
    if not hits:
        return k
    ids = {q: i for i, q in enumerate(sorted({h["q_id"] for h in hits}))}
    vectors = {h["q_id"]: h["vector"] for h in hits}
    tables = codes.tables(np.asarray([vectors[q] for q in ids], dtype=np.float64))
    of = np.asarray([ids[h["q_id"]] for h in hits])
    own = np.asarray([_scored(tables[i:i + 1], np.frombuffer(bytes(h["code"]), np.uint8)[None, :])[0, 0]
                      for i, h in zip(of, hits, strict=True)])
    share = spark.sparkContext.broadcast((tables, own, of))
    counted = (table.select("c_id", "code").mapInArrow(lambda b: _ranks(*share.value)(b), "hit long, n long")
               .groupBy("hit").agg(F.sum("n").alias("n")).select("n").collect())
    share.destroy()
    ranks = np.sort([r["n"] for r in counted])
    return max(k, math.ceil(SPARE * int(ranks[math.ceil(RECALL * len(ranks)) - 1])))


def topk(questions: DataFrame, codes: Codes, k: int = RETRIEVE_K, length: int | None = None, q_id: str = "q_id",
         q_vec: str = "vector", max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """``(q_id, rank, c_id, distance)`` of the k nearest rows of each
    question's shortlist, and the shortlist's length (measured by default)."""
    spark = questions.sparkSession
    ship_package(spark)
    asked = questions.select(F.col(q_id).alias("q_id"), F.col(q_vec).alias("vector"))
    path, found = scratch_path(spark, "questions"), scratch_path(spark, "pq-top-k")
    asked.write.parquet(path)
    asked, table = spark.read.parquet(path), spark.read.parquet(codes.path)
    if length is None:
        length = shortlist_needed(asked, codes, k, max_broadcast_bytes)
    schema = T.StructType([T.StructField("q_id", asked.schema["q_id"].dataType), T.StructField("rank", T.IntegerType()),
                           T.StructField("c_id", table.schema["c_id"].dataType), T.StructField("distance", T.DoubleType())])
    guesses = f"q int, c_id {table.schema['c_id'].dataType.simpleString()}, guess double"
    some = False
    # the tables of a question are 2048 bytes a part, the shortlist of a block is joined by id
    wide = max(1, len(codes.books) * 256 * 8 // max(1, 8 * sum(b.shape[1] for b in codes.books)))
    for ids, q in question_batches(asked, "q_id", "vector", max(1, max_broadcast_bytes // wide)) if codes.books else ():
        share = spark.sparkContext.broadcast(codes.tables(q))
        best = table.select("c_id", "code").mapInArrow(lambda b, s=share: _shortlist(s.value, length)(b), guesses)
        w = Window.partitionBy("q").orderBy("guess", "c_id")
        listed = scratch_path(spark, "pq-shortlist")
        (best.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= length).select("q", "c_id")
         .write.parquet(listed))
        names = spark.createDataFrame([(i, x, v.tolist()) for i, (x, v) in enumerate(zip(ids, q, strict=True))],
                                      T.StructType([T.StructField("q", T.IntegerType()), schema["q_id"],
                                                    T.StructField("asked", T.ArrayType(T.DoubleType()))]))
        pairs = spark.read.parquet(listed).join(table.select("c_id", "vector"), "c_id").join(F.broadcast(names), "q")
        apart = F.zip_with("vector", "asked", lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
        exact = pairs.select("q_id", "c_id", F.sqrt(F.aggregate(apart, F.lit(0.0), lambda s, x: s + x)).alias("distance"))
        w = Window.partitionBy("q_id").orderBy("distance", "c_id")
        (exact.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
         .select("q_id", "rank", "c_id", "distance").write.mode("append").parquet(found))
        share.destroy()
        some = True
    hits = spark.read.schema(schema).parquet(found) if some else spark.createDataFrame([], schema)
    return hits, length
