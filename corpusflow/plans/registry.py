"""Registry of query keys -> Spark query functions and DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crawl, documents, knowledge, links

MODULES = (crawl, documents, knowledge, links)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for m in MODULES:
        for name in dir(m):
            if name.startswith("q_"):
                out[name[2:]] = getattr(m, name)
    return out


def oracle_sql() -> dict[str, str]:
    from ..checks import oracle_crawl, oracle_docs, oracle_kb, oracle_links
    out = {}
    for m in (oracle_crawl, oracle_docs, oracle_kb, oracle_links):
        out.update(m.queries())
    keys = queries()
    return {k: v for k, v in out.items() if k in keys}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Crawl session -> extraction -> store policy -> document keys ->
    per-verdict counts with the number of distinct document keys."""
    from ..operators.reports import stored_flag
    from ..functions.text import safe_title
    s = crawl.with_kind(crawl.session(spark, sf), spark, sf)
    key = F.concat_ws("_", safe_title(F.col("title")), F.substring(F.md5("fetch_url"), 1, 12))
    return (s.withColumn("_stored", stored_flag(s))
            .groupBy("verdict").agg(F.count(F.lit(1)).alias("n"),
                                    F.count_if("_stored").alias("n_stored"),
                                    F.count_distinct(F.when(F.col("_stored"), key)).alias("n_document_keys")))
