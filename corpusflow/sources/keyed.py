"""Tables kept by key in hash buckets, changed a few buckets at a time.

A change reads the buckets that its keys fall into and replaces those buckets
with their new rows (dynamic partition overwrite, which stages all rows before it
replaces a folder); all other buckets stay as they are, file by file. A repeated change finds its rows in
place and leaves the same table.

``store_documents`` keeps the last write of every document, object and sidecar
in one row, so both appear together. ``refresh_chunks`` keeps the chunk table of
a set of documents: only new and altered documents are chunked and embedded,
chunks of removed ones go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ChunkConfig
from ..operators import knowledge as K
from ..session import path_exists, scratch_path
from .keyset import DYNAMIC, key_bucket


def _held(spark: SparkSession, root: str, touched: list[int], like: DataFrame) -> DataFrame:
    """Rows of some buckets, with the columns of ``like``."""
    if not touched or not path_exists(spark, root):
        return like.limit(0)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema if f.name != "bucket")
    return (spark.read.schema(schema + ", bucket int").parquet(root).filter(F.col("bucket").isin(touched))
            .select(*like.columns))


def _replace(rows: DataFrame, root: str, touched: list[int], left: list[int]) -> None:
    """Make ``rows`` the content of the touched buckets; ``left`` are those that
    get rows. ``rows`` may read the same buckets: the old files stay until all
    new ones are written. A large bucket is written by several tasks."""
    spark = rows.sparkSession
    if left:
        (rows.hint("rebalance", "bucket").write.mode("overwrite").option(*DYNAMIC).partitionBy("bucket").parquet(root))
    for bucket in set(touched) - set(left):   # every row of it went
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/bucket={bucket}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _buckets(rows: DataFrame) -> list[int]:
    """Bucket numbers of the rows (at most one a bucket reaches the driver)."""
    return [r[0] for r in rows.select("bucket").distinct().collect()]


def store_documents(docs: DataFrame, root: str, key: str = "filename", order: str = "ordinal", buckets: int = 16) -> str:
    """Keep the last write of every ``key`` with the number of its writes.

    ``docs`` are store calls with a unique, growing ``order``; calls up to the
    stored order of their key are there already and change nothing."""
    spark = docs.sparkSession
    path = scratch_path(spark, "store-calls")
    docs.withColumn("bucket", key_bucket(key, buckets)).write.parquet(path)
    calls = spark.read.parquet(path).filter(F.col(key).isNotNull())
    touched = _buckets(calls)
    held = _held(spark, root, touched, calls.withColumn("writes", F.lit(0).cast("long")))
    # what stays is found out from keys and orders alone; bodies travel once
    before = held.select(key, F.col(order).alias("_order"), F.col("writes").alias("_writes"))
    narrow = calls.select(key, order).join(before, key, "left").filter(
        F.col("_order").isNull() | (F.col(order) > F.col("_order")))
    last = (narrow.groupBy(key).agg(F.max(order).alias(order), F.count(F.lit(1)).alias("_new"))
            .join(before.select(key, "_writes"), key, "left")
            .select(key, order, (F.col("_new") + F.coalesce("_writes", F.lit(0))).alias("writes")))
    path = scratch_path(spark, "last-calls")
    last.write.parquet(path)
    last = spark.read.parquet(path)
    if last.filter((F.col("writes") != 1) | F.col(order).isNull()).isEmpty() and last.count() == calls.count():
        rows = calls.withColumn("writes", F.lit(1).cast("long"))   # each the first of its key
    else:
        rows = calls.join(last, [key, order]).select(*held.columns)
    if not before.join(last, key, "left_anti").isEmpty():
        rows = held.join(last.select(key), key, "left_anti").unionByName(rows)
    _replace(rows, root, touched, touched)   # a touched bucket holds a call, or what was newer
    return root


def refresh_chunks(docs: DataFrame, cfg: ChunkConfig, root: str, doc_id: str = "doc_id", buckets: int = 16) -> int:
    """Bring the chunk table at ``root`` in line with ``docs`` (doc_id,
    source_url, title, text, uri) and return how many documents were embedded.

    A document has changed if the hash of what its chunks are made of has;
    the hashes of all documents are compared without their texts."""
    spark = docs.sparkSession
    content = F.sha2(F.to_json(F.struct("source_url", "title", "text", "uri", F.lit(cfg.size), F.lit(cfg.overlap),
                                        F.lit(cfg.dim), F.lit(cfg.include_title)), {"ignoreNullFields": "false"}), 256)
    key = F.col(doc_id).cast("string")
    docs = docs.withColumn("_key", key).withColumn("bucket", key_bucket("_key", buckets))
    state, table = f"{root.rstrip('/')}/documents", f"{root.rstrip('/')}/chunks"
    path = scratch_path(spark, "document-hashes")
    some = F.coalesce(K.has_words(F.col("text")) & F.col(doc_id).isNotNull(), F.lit(False))
    docs.select(doc_id, "bucket", content.alias("content"), some.alias("has_chunks")).write.parquet(path)
    all_now = spark.read.parquet(path)
    now, first = all_now.drop("has_chunks"), not path_exists(spark, state)
    old = (spark.read.schema(f"{doc_id} long, content string, bucket int").parquet(state)
           if not first else now.limit(0))
    was = old.select(doc_id, F.col("content").alias("_was"), F.col("bucket").alias("_bucket"))
    both = now.join(was, doc_id, "full").filter(~F.col("content").eqNullSafe(F.col("_was")))
    path = scratch_path(spark, "changed-documents")
    both.select(doc_id, F.coalesce("bucket", "_bucket").alias("bucket"), F.col("content").isNotNull().alias("here")).write.parquet(path)
    changed = spark.read.parquet(path)
    touched = _buckets(changed)
    if not touched:
        return 0
    docs = docs.drop("_key")
    # at first every document is new, and no text has to meet the list of the changed
    todo = (docs.filter(F.col(doc_id).isNotNull()) if first
            else docs.join(changed.filter("here").select(doc_id), doc_id, "left_semi"))
    chunks = K.chunk_documents(todo, cfg, doc_id).withColumn("metadata", F.to_json(F.struct("source_url", "title")))
    embed_text = F.concat_ws("\n", F.col("title"), F.col("text")) if cfg.include_title else F.col("text")
    chunks = K.embed(chunks.withColumn("_embed_text", embed_text), "_embed_text", cfg.dim).select(
        "chunk_id", doc_id, "pos", "text", "metadata", "vector", "uri", "bucket")
    kept = _held(spark, table, touched, chunks).join(changed.select(doc_id), doc_id, "left_anti")
    mine = all_now.filter(F.col("bucket").isin(touched))
    _replace(kept.unionByName(chunks), table, touched, _buckets(mine.filter("has_chunks")))
    # the hashes come last: a run that fails before is done again
    _replace(mine.drop("has_chunks"), state, touched, _buckets(mine))
    return changed.filter("here").count()
