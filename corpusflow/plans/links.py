"""Registered link, spacing and streaming queries."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..config import TEST_POLICY, TEST_THIN_LENGTH
from ..operators.crawl import PageTable, crawl_levels
from ..operators.links import link_limits, toc_expand, unvisited_links
from ..operators.reports import spacing_audit, visited_urls
from ..operators.session import fetch_outcome
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import tables as T
from ..streaming.ingest import run_ingest_batches
from . import crawl

POLICY = TEST_POLICY


def _visited(spark, sf):
    return visited_urls(crawl.session(spark, sf))


def q_unvisited_links(spark, sf):
    return unvisited_links(T.toc_links(spark, sf), _visited(spark, sf)).select("page_url", "pos", "link_url")


def q_link_limits(spark, sf):
    return link_limits(T.dense_links(spark, sf), _visited(spark, sf), POLICY)


def toc_pages(spark, sf):
    """Upgraded URLs of fetched HTML pages whose content is thin."""
    fetched = fetch_outcome(F.col("status"), F.col("content_type"), F.col("error"), F.lit(True)) == "fetched"
    thin = crawl.extracted(spark, sf).filter(F.length("content") < TEST_THIN_LENGTH).select("page_id")
    return T.fetch_log(spark, sf).drop("html").filter(fetched).join(thin, "page_id", "left_semi").select("url")


def q_toc_expand(spark, sf):
    """Seeds are the pages no link points to; expansion runs until no new
    page is reached (cycles end through the reached-set anti join)."""
    ensure_checkpoint_dir(spark)
    links = T.toc_links(spark, sf).checkpoint()   # read by the seed query and the expansion
    pages = T.read_table(spark, sf, "pages").select("url")
    seeds = pages.join(links.select(F.col("link_url").alias("url")), "url", "left_anti")
    return toc_expand(seeds, toc_pages(spark, sf), links, POLICY)


#: Levels below the seeds that the registered crawl follows.
FOLLOW_DEPTH = 4


def q_crawl_follow(spark, sf):
    """Crawl over the links found in the pages' own markup: seeds are pages no
    page leads to, thin pages hand on their links, the budget is half of all
    pages."""
    pages = T.read_table(spark, sf, "pages").select("page_id", "url")
    led_to = T.page_edges(spark, sf).select(F.col("to").alias("page_id"))
    seeds = pages.join(led_to, "page_id", "left_anti").select(F.col("page_id").alias("ordinal"), "url")
    policy = POLICY.with_(max_pages=pages.count() // 2, max_link_depth=FOLLOW_DEPTH)
    log = PageTable.write(T.fetch_log(spark, sf, pages=T.linked_pages(spark, sf)))
    rows = crawl_levels(seeds, log, policy, T.robots_rules(spark, sf, policy.agent_token))
    return rows.select("depth", "url", "fetch_url", "verdict", (F.col("new_visit") & (F.col("verdict") == "ok")).alias("visited"),
                       "kind", "link_count")


def q_request_spacing(spark, sf):
    """Audit of the request log: gap to the previous request overall (the
    crawler's delay is global, not per host) and whether it is too short;
    -1 / false for the first request."""
    a = spacing_audit(T.read_table(spark, sf, "events"), POLICY.request_delay)
    return a.select("event_id", F.coalesce("gap_us", F.lit(-1)).alias("gap_us"),
                    F.coalesce("too_close", F.lit(False)).alias("too_close"))


def q_stream_ingest(spark, sf):
    """``pages`` in two deliveries that overlap (page ids with remainders 0-4
    and 3-6 modulo 7), each written with the scan's own partitioning and taken
    in by a run of the stream with the same checkpoint; the result equals the
    batch result on the distinct pages."""
    root = scratch_path(spark, "stream-in")
    pages = T.read_table(spark, sf, "pages")
    sink, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    part = F.pmod("page_id", F.lit(7))
    for name, some in (("d0", part <= 4), ("d1", part >= 3)):
        pages.filter(some).write.parquet(os.path.join(root, name))
        # the deployed budget (three pages per seed) never binds, as in crawl.session
        out = run_ingest_batches(spark, os.path.join(root, "*", "*.parquet"), pages.schema,
                                 POLICY.with_(max_pages=None), sink, ckpt)
    return out.select("fetch_url", "title", F.length("content").alias("content_length"))
