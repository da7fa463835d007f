"""Page extraction and page classification over a whole table of pages.

``extract_pages`` is one narrow projection (no shuffle): at scale it runs
map-side on the page snapshot, and only the extracted columns (bounded by
``max_content_length``) travel through later joins, never the raw HTML.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (MAX_FOLLOW_LINKS, PREVIEW_CHARS, SAMPLE_LINKS, CrawlPolicy)
from ..functions import html as H
from ..functions.urls import is_followable


def extract_pages(df: DataFrame, policy: CrawlPolicy, url_col: str = "url",
                  html_col: str = "html", tags=None, keep_html: bool = False) -> DataFrame:
    """Add ``title, meta_description, content, links`` computed from HTML.

    ``url_col`` must hold the (upgraded) page URL links are resolved against.
    ``tags`` overrides the boilerplate element list.
    """
    from ..session import spread
    tags = policy.boilerplate_tags if tags is None else tags
    doc = H.strip_boilerplate(F.col(html_col), tags)
    out = (spread(df).withColumn("_doc", doc)
           .withColumn("title", H.page_title(F.col("_doc")))
           .withColumn("meta_description", H.meta_description(F.col("_doc")))
           .withColumn("content", H.truncate_content(
               H.clean_text(H.main_region(F.col("_doc"))), policy.max_content_length))
           .withColumn("links", H.page_links(F.col("_doc"), F.col(url_col)))
           .drop("_doc"))
    return out if keep_html else out.drop(html_col)


def follow_links(links_col: str, policy: CrawlPolicy):
    """Links a thin page hands back: allowed domain and no excluded
    extension (visited URLs are removed by the caller's anti join)."""
    return F.filter(F.col(links_col), lambda l: is_followable(l["url"], policy))


def page_kind(df: DataFrame, policy: CrawlPolicy, min_length: int | None = None) -> DataFrame:
    """Classify extracted pages: ``thin_toc`` (short, with followable links),
    ``thin_empty`` (short, none) or ``ok``; thin TOC pages carry their first
    20 follow links and the uncapped ``link_count``."""
    n = policy.min_content_length if min_length is None else min_length
    follow = follow_links("links", policy)
    thin = F.length("content") < n
    return (df.withColumn("_follow", follow)
            .withColumn("kind", F.when(thin & (F.size("_follow") > 0), "thin_toc")
                        .when(thin, "thin_empty").otherwise("ok"))
            .withColumn("content_length", F.length("content"))
            .withColumn("link_count", F.when(F.col("kind") == "thin_toc", F.size("_follow")))
            .withColumn("follow_these_links", F.when(
                F.col("kind") == "thin_toc",
                F.transform(F.slice("_follow", 1, MAX_FOLLOW_LINKS), lambda l: l["url"])))
            .drop("_follow"))


def store_policy(df: DataFrame) -> DataFrame:
    """Pages that become documents: fetched HTML with enough content."""
    return df.filter(F.col("kind") == "ok")


def page_preview(df: DataFrame) -> DataFrame:
    """Result row of an ok page: 2000-character preview, full length,
    link count and the first five links."""
    return df.select(
        "url", "title", "meta_description",
        F.substring("content", 1, PREVIEW_CHARS).alias("content"),
        F.length("content").alias("full_content_length"),
        F.size("links").alias("links_found"),
        F.slice("links", 1, SAMPLE_LINKS).alias("sample_links"),
        *[c for c in ("ordinal", "pages_crawled_so_far") if c in df.columns])
