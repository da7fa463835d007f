"""Corpus pipeline: quality rules, SimHash near-dedup, suffix-array dedup,
best-fit packing over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read back as the next stage's ``docs``. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import linecrf, packing, queries, simhash, suffix
from corpusflow.llm.common import materialise, table, tmp


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules and the line field keep."""
    model = linecrf.fit(docs, table(spark, sf_dir, "labels"))
    m = tmp("measures")
    return linecrf.measure(docs, model, out=m).filter(linecrf.kept(F.col(m))).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return simhash.drop_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated 100-byte strings: a character that loses a
    byte goes whole, and ``n_chars`` follows the text. Documents stay, also
    with an empty text."""
    kept, spans, raw = tmp("kept"), tmp("spans"), tmp("raw")
    out = suffix.drop_repeats(docs, spans=spans, kept=raw, kept_text=kept)
    new = {"text": F.when(F.col("text").isNotNull(), F.col(kept)), "n_chars": F.char_length(kept).cast("long")}
    return out.select(*[new[c].alias(c) if c in new else c for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024 tokens."""
    pieces = queries.packed_pieces(docs.select("doc_id", "text"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("simhash_dedup", simhash_dedup),
          ("suffix_dedup", suffix_dedup), ("best_fit_packing", best_fit_packing)]

#: The line model, fingerprints by XXH64 and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
