"""Link operators: visited filtering, per-page link caps and the
table-of-contents expansion (breadth-first, one Spark job per level).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import MAX_FOLLOW_LINKS, MAX_LINKS_PER_PAGE, SAMPLE_LINKS, CrawlPolicy
from ..functions.urls import has_excluded_extension, https_upgrade, is_allowed_domain
from ..session import ensure_checkpoint_dir


def unvisited_links(links: DataFrame, visited: DataFrame, link_col: str = "link_url") -> DataFrame:
    """Drop links whose URL string is in the visited set. The comparison is
    on the raw link string against visited (upgraded) URLs, so an
    ``http://`` link never counts as visited."""
    v = visited.select(F.col("url").alias("_v")).distinct()
    return links.join(v, links[link_col] == v["_v"], "left_anti")


def link_limits(links: DataFrame, visited: DataFrame, policy: CrawlPolicy,
                page_col: str = "page_url") -> DataFrame:
    """Per page: links kept (first 50 in page order), the follow candidates
    of a thin page (allowed domain, no excluded extension, not visited)
    with their uncapped count, the first 20 of them, and the 5 sampled.

    Link positions come from extraction, which already keeps at most 50
    links per page, so each per-page window holds a bounded number of rows.
    """
    kept = links.filter(F.col("pos") < MAX_LINKS_PER_PAGE)
    cand = (unvisited_links(kept, visited)
            .filter(is_allowed_domain(F.col("link_url"), policy) & ~has_excluded_extension(F.col("link_url"), policy)))
    ranked = cand.withColumn("_r", F.row_number().over(Window.partitionBy(page_col).orderBy("pos")))
    c = ranked.groupBy(page_col).agg(F.count(F.lit(1)).alias("link_count"),
                                     F.count_if(F.col("_r") <= MAX_FOLLOW_LINKS).alias("n_follow"))
    k = kept.groupBy(page_col).agg(F.count(F.lit(1)).alias("links_found"),
                                   F.count_if(F.col("pos") < SAMPLE_LINKS).alias("n_sample"))
    return (k.join(c, page_col, "left")
            .select(page_col, "links_found", "n_sample",
                    F.coalesce("link_count", F.lit(0)).alias("link_count"),
                    F.coalesce("n_follow", F.lit(0)).alias("n_follow")))


def toc_expand(seeds: DataFrame, toc_pages: DataFrame, links: DataFrame, policy: CrawlPolicy,
               max_depth: int | None = None) -> DataFrame:
    """Breadth-first expansion from ``seeds(url)`` through table-of-contents
    pages: ``(url, depth)`` for every URL reached, at its smallest depth.

    ``toc_pages(url)`` holds the upgraded URLs of fetched pages that are thin;
    ``links(page_url, pos, link_url)`` holds raw URLs. A frontier page that
    is a TOC page hands over its first 20 links that pass the domain and
    extension rules and were not reached before; the loop stops when the
    frontier is empty or ``max_depth`` is reached.

    Each level is one job; the only driver round trip is "is the frontier
    empty". Each new frontier is checkpointed to the shared checkpoint
    folder, which cuts lineage and survives executor loss; the reached set
    is the union of those checkpointed levels.
    """
    ensure_checkpoint_dir(seeds.sparkSession)
    # Followable links of TOC pages, computed once and materialised in the
    # shared checkpoint folder: only links among a page's first 50 (the
    # extraction cap, so the per-page window below is bounded), allowed
    # domain, no excluded extension, from pages that are thin.
    toc = toc_pages.select(F.col("url").alias("_toc")).distinct()
    lk = links.filter((F.col("pos") < MAX_LINKS_PER_PAGE) & is_allowed_domain(F.col("link_url"), policy)
                      & ~has_excluded_extension(F.col("link_url"), policy))
    # hash-partitioned by page before the checkpoint: the partitioning is
    # kept, so each level's semi join only shuffles the (small) frontier
    n = int(seeds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lk_toc = (lk.join(toc, https_upgrade(lk["page_url"]) == toc["_toc"], "left_semi")
              .repartition(n, "page_url").checkpoint())
    frontier = seeds.select("url").distinct().withColumn("depth", F.lit(0)).checkpoint()
    reached = frontier
    depth = 0
    while max_depth is None or depth < max_depth:
        cand = lk_toc.join(frontier.select(F.col("url").alias("page_url")), "page_url", "left_semi")
        cand = cand.join(reached.select(F.col("url").alias("link_url")), "link_url", "left_anti")
        first20 = (cand.withColumn("_r", F.row_number().over(Window.partitionBy("page_url").orderBy("pos")))
                   .filter(F.col("_r") <= MAX_FOLLOW_LINKS))
        nxt = (first20.select(F.col("link_url").alias("url")).distinct()
               .withColumn("depth", F.lit(depth + 1)).checkpoint())
        if nxt.isEmpty():
            break
        # a union of checkpointed levels: shallow lineage, nothing recomputed
        reached = reached.unionByName(nxt)
        frontier = nxt
        depth += 1
    return reached
