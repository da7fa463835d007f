"""Stream = batch: pages delivered as two files, one of them twice."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from corpusflow.config import TEST_POLICY
from corpusflow.functions.urls import https_upgrade
from corpusflow.operators.admission import policy_rule
from corpusflow.session import scratch_path
from corpusflow.streaming.ingest import run_ingest


def test_stream_equals_batch(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    root = scratch_path(spark, "t-stream")
    a, b = pages.filter("page_id % 2 = 0"), pages.filter("page_id % 2 = 1")
    a.coalesce(1).write.parquet(os.path.join(root, "d0"))
    b.coalesce(1).write.parquet(os.path.join(root, "d1"))
    a.coalesce(1).write.parquet(os.path.join(root, "d2"))
    out = run_ingest(spark, os.path.join(root, "*", "*.parquet"), pages.schema, TEST_POLICY,
                     scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt"))
    batch = (pages.filter(policy_rule(F.col("url"), TEST_POLICY).isNull())
             .select(https_upgrade(F.col("url")).alias("u")).distinct())
    assert out.count() == batch.count()
    assert {r[0] for r in out.select("fetch_url").collect()} == {r[0] for r in batch.collect()}


def test_sink_backed_stream_with_budget(spark):
    from corpusflow.streaming.ingest import run_ingest_batches
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    root = scratch_path(spark, "t-stream2")
    first = os.path.join(root, "d0")
    pages.repartition(2, "page_id").write.parquet(first)
    written = spark.read.parquet(first)
    name = written.select(F.min("_metadata.file_name")).first()[0]
    written.filter(F.col("_metadata.file_name") == name).write.parquet(os.path.join(root, "d1"))
    glob = os.path.join(root, "*", "*.parquet")
    out = run_ingest_batches(spark, glob, pages.schema, TEST_POLICY.with_(max_pages=None),
                             scratch_path(spark, "t-sink2"), scratch_path(spark, "t-ckpt2"), files_per_batch=1)
    batch = (pages.filter(policy_rule(F.col("url"), TEST_POLICY).isNull())
             .select(https_upgrade(F.col("url")).alias("u")).distinct())
    assert out.count() == batch.count() == out.select("fetch_url").distinct().count()
    capped = run_ingest_batches(spark, glob, pages.schema, TEST_POLICY.with_(max_pages=7),
                                scratch_path(spark, "t-sink3"), scratch_path(spark, "t-ckpt3"))
    assert capped.count() == 7
    # one micro-batch holding every delivery gives the same documents
    once = run_ingest_batches(spark, glob, pages.schema, TEST_POLICY.with_(max_pages=None),
                              scratch_path(spark, "t-sink4"), scratch_path(spark, "t-ckpt4"))
    assert {r[0] for r in once.select("fetch_url").collect()} == {r[0] for r in out.select("fetch_url").collect()}
    assert once.count() == out.count()


def test_key_set(spark):
    from corpusflow.sources.keyset import KeySet
    keys = KeySet(spark, scratch_path(spark, "t-keys"), buckets=2, bucket_keys=400)

    def table(a, b):
        return spark.range(a, b).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    assert keys.known(table(0, 10), "k", 0).count() == 0 and keys.keys_read == 0
    for batch, (a, b) in enumerate([(0, 500), (500, 1500), (1500, 4000)]):
        keys.add(table(a, b), "k", batch)
    assert keys.size() == 4000 and keys.buckets == 16
    got = keys.known(table(3990, 4010).unionByName(table(3990, 4000)), "k", 3)
    assert sorted(r[0] for r in got.collect()) == sorted(f"k{i}" for i in range(3990, 4000))
    assert keys.known(table(1490, 1510), "k", 2).count() == 10          # only batches before 2
    keys.add(table(1500, 4000), "k", 2)                                 # a repeated batch
    assert keys.size() == 4000
    new = table(10_000, 10_050)
    assert keys.known(new, "k", 3).count() == 0
    assert keys.buckets_read < 16                                       # most new keys stop at a filter


def test_keys_read_by_a_batch_do_not_grow_with_the_sink(spark):
    from corpusflow.sources.keyset import KeySet
    keys, read = KeySet(spark, scratch_path(spark, "t-keys2"), buckets=2, bucket_keys=300), []
    for batch in range(4):
        held = [1000, 2000, 4000, 8000][batch]
        start = keys.size()
        keys.add(spark.range(start, held).select(F.col("id").cast("string").alias("k")), "k", batch)
        keys.known(spark.createDataFrame([("7",), ("9",)], "k string"), "k", batch + 1)
        read.append(keys.keys_read)
    assert keys.size() == 8000 and max(read) <= 4 * 300 and keys.buckets == 32


def test_a_retried_batch_changes_nothing(spark):
    from corpusflow.streaming.ingest import ingest_batch, pages_before
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    sink = scratch_path(spark, "t-sink5")
    half, pol = pages.filter("page_id % 2 = 0"), TEST_POLICY.with_(max_pages=20)
    ingest_batch(half, 0, pol, sink)
    one = sorted(r[0] for r in spark.read.parquet(sink).select("fetch_url").collect())
    ingest_batch(half, 0, pol, sink)
    assert sorted(r[0] for r in spark.read.parquet(sink).select("fetch_url").collect()) == one
    assert pages_before(spark, sink, 1) == len(one)
    ingest_batch(pages, 1, pol, sink)
    ingest_batch(pages, 1, pol, sink)
    out = spark.read.parquet(sink)
    assert out.count() == 20 == out.select("fetch_url").distinct().count() == pages_before(spark, sink, 2)
