"""Crawl levels with incremental state.

A crawl takes its seeds and then, level by level, the links that thin
table-of-contents pages hand back. What earlier levels left is kept as state:
the visited set (``KeySet``), the number of pages it holds and the next ordinal.
A level runs the session over its own rows only; it reads the buckets of the
visited set and of the page table that its URLs fall into, and it extracts only
pages that it fetched. Its rows are stored as one partition of the session.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import MAX_FOLLOW_LINKS, CrawlPolicy
from ..functions.urls import has_excluded_extension, https_upgrade, is_allowed_domain
from ..session import scratch_path
from ..sources.keyset import KeySet, key_bucket
from .extract import extract_pages, page_kind
from .session import crawl_session, ordinals


@dataclass
class PageTable:
    """Fetch log by URL bucket, so a frontier reads the buckets it can hit."""
    spark: SparkSession
    path: str
    buckets: int

    @staticmethod
    def write(log: DataFrame, buckets: int = 16) -> "PageTable":
        spark = log.sparkSession
        path = scratch_path(spark, "pages-by-url")
        (log.withColumn("bucket", key_bucket("url", buckets)).repartition("bucket").write.partitionBy("bucket")
         .parquet(path))
        return PageTable(spark, path, buckets)

    def near(self, urls: DataFrame, key: str) -> DataFrame:
        """Rows of the buckets of ``urls``."""
        touched = [r[0] for r in urls.select(key_bucket(key, self.buckets)).distinct().collect()]
        return self.spark.read.parquet(self.path).filter(F.col("bucket").isin(touched)).drop("bucket")


@dataclass
class CrawlState:
    """What a level needs of the levels before it."""
    visited: KeySet
    root: str
    pages: int = 0           # visited so far
    ordinal: int = 0         # of the next row

    @staticmethod
    def start(spark: SparkSession, **sizes) -> "CrawlState":
        return CrawlState(KeySet(spark, scratch_path(spark, "crawl-visited"), **sizes), scratch_path(spark, "crawl-session"))


def crawl_level(rows: DataFrame, pages: PageTable, policy: CrawlPolicy, state: CrawlState, level: int,
                robots: DataFrame | None = None) -> DataFrame:
    """Session over the rows ``(ordinal, url)`` of one level; adds ``depth``,
    ``kind`` and the extracted page of fetched rows, stores the rows and moves
    the state on."""
    spark = rows.sparkSession
    rows = rows.select("ordinal", "url").withColumn("fetch_url", https_upgrade(F.col("url"))).checkpoint()
    log = pages.near(rows, "fetch_url")
    page_columns = [c for c in ("html", "title", "meta_description", "content", "links") if c in log.columns]
    known = state.visited.known(rows, "fetch_url", level).checkpoint()
    session = crawl_session(rows.drop("fetch_url"), log.drop(*page_columns), policy, robots, known=known,
                            used=state.pages)
    path = f"{state.root}/verdicts-{level}"
    session.write.mode("overwrite").parquet(path)
    session = spark.read.parquet(path)
    fetched = session.filter("verdict = 'ok'").select("fetch_url").distinct()
    page = log.select(F.col("url").alias("fetch_url"), *page_columns).join(fetched, "fetch_url", "left_semi")
    if "html" in page_columns:
        page = extract_pages(page, policy, url_col="fetch_url")
    page = page_kind(page, policy)
    out = session.join(page, "fetch_url", "left").withColumn("depth", F.lit(level))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("depth")
     .parquet(f"{state.root}/rows"))
    new = session.filter("new_visit AND verdict = 'ok'").select("fetch_url")
    state.visited.add(new, "fetch_url", level)
    state.pages += new.count()
    return spark.read.parquet(f"{state.root}/rows").filter(F.col("depth") == level)


def follow_up(session: DataFrame, policy: CrawlPolicy, state: CrawlState, level: int) -> DataFrame:
    """Links handed back by the thin pages of a level: ``(parent_ordinal,
    rank, url)``, at most 20 a page, in link order.

    A link is followable if its host is allowed, its path has no excluded
    extension and its URL string was not visited when the page was fetched: not
    in an earlier level, nor in this one before the page or by the page itself."""
    thin = session.filter("verdict = 'ok' AND kind = 'thin_toc'")
    links = (thin.select("ordinal", F.posexplode("links").alias("pos", "l"))
             .select("ordinal", "pos", F.col("l.url").alias("url"))
             .filter(is_allowed_domain(F.col("url"), policy) & ~has_excluded_extension(F.col("url"), policy)))
    links = links.join(state.visited.known(links, "url", level), "url", "left_anti")
    here = session.filter("new_visit AND verdict = 'ok'").select(F.col("fetch_url").alias("url"),
                                                                 F.col("ordinal").alias("_at"))
    fresh = links.join(here, "url", "left").filter(F.col("_at").isNull() | (F.col("_at") > F.col("ordinal")))
    # at most 50 links a page (extraction cap): the window is bounded
    ranked = fresh.withColumn("rank", F.row_number().over(Window.partitionBy("ordinal").orderBy("pos")))
    return ranked.filter(F.col("rank") <= MAX_FOLLOW_LINKS).select(F.col("ordinal").alias("parent_ordinal"), "rank", "url")


def crawl_levels(seeds: DataFrame, pages: PageTable, policy: CrawlPolicy, robots: DataFrame | None = None,
                 state: CrawlState | None = None) -> DataFrame:
    """Session over ``seeds(ordinal, url)`` and the follow-up of thin pages, up
    to ``policy.max_link_depth`` levels, in (depth, parent, link) order."""
    spark = seeds.sparkSession
    state = state or CrawlState.start(spark)
    rows = seeds.select("ordinal", "url").checkpoint()
    for level in range(policy.max_link_depth + 1):
        top = rows.agg(F.max("ordinal")).first()[0]
        if top is None:
            break
        state.ordinal = top + 1
        session = crawl_level(rows, pages, policy, state, level, robots)
        if level < policy.max_link_depth:
            rows = ordinals(follow_up(session, policy, state, level), "parent_ordinal", "rank").select(
                (F.lit(state.ordinal) + F.col("ordinal")).alias("ordinal"), "url")
    return spark.read.parquet(f"{state.root}/rows")
