"""Document store sinks and the corpus scan that reads them back.

One file per document is not Spark-shaped at scale, so the store is a pair
of tables under a prefix: objects ``(key, body)`` and sidecars
``(sidecar_key, sidecar)``. ``write_files`` and ``file_corpus`` keep one file per
document with its sidecar beside it, for tools that need files;
``read_text_corpus`` reads any folder of plain files laid out like that.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .files import DocumentFiles

SIDECAR_SCHEMA = ("struct<metadataAttributes: struct<"
                  "source_url: struct<value: struct<type: string, stringValue: string>, includeForEmbedding: boolean>, "
                  "title: struct<value: struct<type: string, stringValue: string>, includeForEmbedding: boolean>>>")


def write_store(objects: DataFrame, sidecars: DataFrame, root: str) -> str:
    """Write objects and sidecars under ``root`` (a shared folder)."""
    objects.select("key", "body").write.mode("overwrite").parquet(os.path.join(root, "objects"))
    sidecars.select("sidecar_key", "sidecar").write.mode("overwrite").parquet(os.path.join(root, "sidecars"))
    return root


def corpus_scan(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Objects under ``prefix`` paired with their optional sidecar:
    ``(key, body, source_url, title)``. Without a sidecar the source falls
    back to the object location and the title to ''."""
    obj = spark.read.parquet(os.path.join(root, "objects"))
    if prefix:
        obj = obj.filter(F.col("key").startswith(prefix))
    side = spark.read.parquet(os.path.join(root, "sidecars"))
    j = obj.join(side, F.concat(obj["key"], F.lit(".metadata.json")) == side["sidecar_key"], "left")
    m = F.from_json("sidecar", SIDECAR_SCHEMA)["metadataAttributes"]
    return j.select("key", "body",
                    F.coalesce(m["source_url"]["value"]["stringValue"],
                               F.concat(F.lit("store://"), F.col("key"))).alias("source_url"),
                    F.coalesce(m["title"]["value"]["stringValue"], F.lit("")).alias("title"))


def read_text_corpus(spark: SparkSession, folder: str, glob: str = "*.md") -> DataFrame:
    """One row per file ``(path, body, source_url, title)`` from a folder of
    documents with optional ``<file>.metadata.json`` sidecars."""
    # ``text()`` resets ``wholetext`` from its keyword, so pass it there
    docs = (spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body")))
    side = (spark.read.option("pathGlobFilter", "*.metadata.json").text(folder, wholetext=True)
            .select(F.col("_metadata.file_path").alias("sidecar_path"), F.col("value").alias("sidecar")))
    j = docs.join(side, F.concat(docs["path"], F.lit(".metadata.json")) == side["sidecar_path"], "left")
    m = F.from_json("sidecar", SIDECAR_SCHEMA)["metadataAttributes"]
    return j.select("path", "body",
                    F.coalesce(m["source_url"]["value"]["stringValue"], F.col("path")).alias("source_url"),
                    F.coalesce(m["title"]["value"]["stringValue"], F.lit("")).alias("title"))


def write_files(objects: DataFrame, sidecars: DataFrame, root: str) -> str:
    """One file per object under ``root`` with its sidecar beside it."""
    _files(objects.sparkSession)
    side = sidecars.select(F.expr("left(sidecar_key, length(sidecar_key) - 14)").alias("key"), "sidecar")
    (objects.select("key", "body").join(side, "key", "left").select("key", "body", "sidecar")
     .write.format("document_files").mode("append").save(root))
    return root


def file_corpus(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """``corpus_scan`` over single files: ``(key, body, source_url, title)``."""
    _files(spark)
    m = F.from_json("sidecar", SIDECAR_SCHEMA)["metadataAttributes"]
    return spark.read.format("document_files").option("prefix", prefix).load(root).select(
        "key", "body",
        F.coalesce(m["source_url"]["value"]["stringValue"], F.concat(F.lit("store://"), F.col("key"))).alias("source_url"),
        F.coalesce(m["title"]["value"]["stringValue"], F.lit("")).alias("title"))


def _files(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(DocumentFiles)


def write_chunk_table(chunks: DataFrame, root: str) -> str:
    """Vector-store rows ``(chunk_id, doc_id, pos, text, metadata, vector)``
    plus the object location ``uri`` when present; metadata stays a plain,
    unindexed string column."""
    path = os.path.join(root, "chunks")
    cols = ["chunk_id", "doc_id", "pos", "text", "metadata", "vector"] + (["uri"] if "uri" in chunks.columns else [])
    chunks.select(*cols).write.mode("overwrite").parquet(path)
    return path
