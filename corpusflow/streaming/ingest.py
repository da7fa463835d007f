"""Incremental page intake with Structured Streaming.

New page files arriving in a folder are admitted, de-duplicated on the
upgraded URL, extracted and appended to a document sink. A fresh
checkpoint is a fresh crawl state (empty visited set); re-running with the
same checkpoint continues where the last run stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CrawlPolicy
from ..operators.admission import with_policy
from ..operators.extract import extract_pages
from ..session import path_exists
from ..sources.keyset import KeySet


def ingest_stream(source: DataFrame, policy: CrawlPolicy, event_time: str | None = None,
                  watermark: str = "1 day") -> DataFrame:
    """Streaming transform: admission rules, dedupe on the upgraded URL,
    extraction. Without an event-time column the dedupe state holds every
    URL seen (the crawler's visited set never expires either); with one,
    ``dropDuplicatesWithinWatermark`` bounds the state."""
    s = with_policy(source, policy).filter(F.col("rule").isNull())
    if event_time:
        s = s.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(["fetch_url"])
    else:
        s = s.dropDuplicates(["fetch_url"])
    return extract_pages(s, policy, url_col="fetch_url").drop("rule")


def run_ingest(spark: SparkSession, source_glob: str, schema, policy: CrawlPolicy, sink: str,
               checkpoint: str, files_per_batch: int = 1) -> DataFrame:
    """Process every file available now (one file per micro-batch by
    default), append to the parquet ``sink`` and return the sink table."""
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
           .parquet(source_glob))
    out = ingest_stream(src, policy).withColumn("links", F.to_json("links"))
    q = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


def visited_keys(spark: SparkSession, sink: str, **sizes) -> KeySet:
    """The visited set of a sink, kept beside it."""
    return KeySet(spark, f"{sink.rstrip('/')}-visited", **sizes)


def pages_before(spark: SparkSession, sink: str, batch_id: int) -> int:
    """Pages stored by earlier batches: the newest counter before this batch."""
    path = f"{sink.rstrip('/')}-pages"
    if not path_exists(spark, path):
        return 0
    rows = spark.read.schema("pages long, batch_id long").parquet(path).filter(F.col("batch_id") < batch_id)
    last = rows.agg(F.max(F.struct("batch_id", "pages")).alias("last")).first()["last"]
    return last["pages"] if last else 0


def ingest_batch(batch: DataFrame, batch_id: int, policy: CrawlPolicy, sink: str,
                 order_col: str = "page_id", visited: KeySet | None = None) -> None:
    """One micro-batch of the sink-backed intake (``foreachBatch``).

    * admission rules, then the first row per upgraded URL inside the batch
      (its least ``order_col``, unique, is aggregated alone and joined back, so
      no HTML sits in an aggregation buffer);
    * URLs of earlier batches are dropped: the visited set says which of the
      batch's URLs it knows and reads only the buckets that can hold them;
    * the page budget: only ``max_pages`` minus the pages stored so far (a
      counter kept with every batch) are kept, in ``order_col`` order;
    * written as partition ``batch_id`` with dynamic overwrite, then the keys
      and the counter under the same number, so a retried batch replaces what
      it left (idempotent).
    """
    from ..operators.session import kth_smallest
    spark = batch.sparkSession
    visited = visited or visited_keys(spark, sink)
    admitted = with_policy(batch, policy).filter(F.col("rule").isNull()).drop("rule")
    keys = admitted.groupBy("fetch_url").agg(F.min(order_col).alias(order_col))
    keys = keys.join(visited.known(keys, "fetch_url", batch_id), "fetch_url", "left_anti")
    stored = pages_before(spark, sink, batch_id)
    if policy.max_pages is not None:
        room = policy.max_pages - stored
        if room <= 0:
            keys = keys.limit(0)
        else:
            cut = kth_smallest(keys, order_col, room)
            if cut is not None:
                keys = keys.filter(F.col(order_col) <= cut)
    fresh = admitted.join(keys, ["fetch_url", order_col], "left_semi")
    # a page delivered twice in one batch is one document
    out = (extract_pages(fresh, policy, url_col="fetch_url").dropDuplicates(["fetch_url"])
           .withColumn("links", F.to_json("links")).withColumn("batch_id", F.lit(batch_id)))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(sink))
    part = f"{sink.rstrip('/')}/batch_id={batch_id}"
    new = spark.read.schema("fetch_url string").parquet(part) if path_exists(spark, part) else None
    if new is not None:
        visited.add(new, "fetch_url", batch_id)
    total = stored + (new.count() if new is not None else 0)
    (spark.range(1).select(F.lit(total).cast("long").alias("pages"), F.lit(batch_id).cast("long").alias("batch_id"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
     .parquet(f"{sink.rstrip('/')}-pages"))


def run_ingest_batches(spark: SparkSession, source_glob: str, schema, policy: CrawlPolicy, sink: str,
                       checkpoint: str, files_per_batch: int = 1000, order_col: str = "page_id",
                       visited: KeySet | None = None) -> DataFrame:
    """Sink-backed incremental intake: every file available now, at most
    ``files_per_batch`` in a micro-batch, processed by ``ingest_batch``."""
    visited = visited or visited_keys(spark, sink)
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
           .parquet(source_glob))
    q = (src.writeStream.foreachBatch(lambda df, bid: ingest_batch(df, bid, policy, sink, order_col, visited))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)
