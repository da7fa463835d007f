"""A crawl session over a whole seed table.

The crawler handles seeds one at a time with a visited set and a page
budget. Both are order-dependent, and both are computed here without a
global sort:

* visited: a row is "already visited" when an earlier row of the same
  upgraded URL succeeded. That is ``ordinal > first_ok(norm_url)``, where
  ``first_ok`` is a partial-aggregated ``min`` per URL joined back, so a
  URL holding a third of all rows is never gathered into one task.
* budget: the number of new successes before each row, from a two-level
  prefix count (counts per even range of the order, a prefix over the ranges,
  then a running count inside each range).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import CrawlPolicy
from ..session import ensure_checkpoint_dir, shuffle_partitions
from .admission import robots_allowed, with_policy


def in_pieces(df: DataFrame, order_col: str) -> DataFrame:
    """``df`` dealt into ranges of ``order_col`` (Spark samples the bounds, so
    the ranges are even whatever the values' spacing), each row tagged with its
    range ``_piece``; checkpointed, so the tags are fixed."""
    ensure_checkpoint_dir(df.sparkSession)
    n = shuffle_partitions(df.sparkSession)
    return df.repartitionByRange(n, order_col).withColumn("_piece", F.spark_partition_id()).checkpoint()


def running_count_before(df: DataFrame, flag: str, order_col: str = "ordinal",
                         out: str = "count_before") -> DataFrame:
    """Add ``out`` = number of rows with ``flag`` true and a smaller
    ``order_col`` (a unique long, dense or not).

    Rows are dealt into even ranges of ``order_col``; counts per range, a
    prefix over the ranges (as many as shuffle partitions) and a running count
    inside each range. No step sorts the whole table in one task. Pass narrow
    rows: every column travels through one shuffle and a checkpoint.
    """
    pieces = in_pieces(df, order_col)
    counts = pieces.groupBy("_piece").agg(F.count_if(F.col(flag)).alias("_n"))
    prefix = counts.select("_piece", F.coalesce(F.sum("_n").over(
        Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    within = F.coalesce(F.sum(F.col(flag).cast("long")).over(
        Window.partitionBy("_piece").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))
    return (pieces.join(F.broadcast(prefix), "_piece")
            .withColumn(out, F.col("_base") + within).drop("_piece", "_base"))


def ordinals(df: DataFrame, *order: str, out: str = "ordinal") -> DataFrame:
    """Add a unique long that follows the order of the given columns: the
    position inside an even, sorted range after the range's number."""
    ensure_checkpoint_dir(df.sparkSession)
    n = shuffle_partitions(df.sparkSession)
    return (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn(out, F.monotonically_increasing_id()).checkpoint())


def fetch_outcome(status, content_type, error, captured):
    """Outcome label of a fetch: missing snapshot row, timeout, other error,
    HTTP status >= 400, non-HTML content type, or fetched."""
    return (F.when(~captured, F.lit("not_captured"))
            .when(error == "timeout", F.lit("timeout"))
            .when(error.isNotNull(), F.lit("error"))
            .when(status >= 400, F.lit("http_error"))
            .when(~F.coalesce(content_type, F.lit("")).contains("text/html"), F.lit("not_html"))
            .otherwise(F.lit("fetched")))


def page_fetch(frontier: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Left join admitted rows with the captured snapshot on the upgraded URL
    and label the outcome. ``snapshot`` is keyed by ``url`` (unique)."""
    snap = snapshot.withColumnRenamed("url", "fetch_url").withColumn("_captured", F.lit(True))
    j = frontier.join(snap, "fetch_url", "left")
    return (j.withColumn("outcome", fetch_outcome(
        F.col("status"), F.col("content_type"), F.col("error"),
        F.coalesce(F.col("_captured"), F.lit(False)))).drop("_captured"))


def kth_smallest(df: DataFrame, col: str, k: int):
    """The k-th smallest value of a unique long column, or None when there
    are fewer than k rows. Only one scalar reaches the driver."""
    counted = running_count_before(df.select(col, F.lit(True).alias("_one")), "_one", col, "_before")
    hit = counted.filter(F.col("_before") == k - 1).select(col).first()
    return None if hit is None else hit[0]


def crawl_session(seeds: DataFrame, snapshot: DataFrame, policy: CrawlPolicy,
                  robots: DataFrame | None = None, running_counts: bool = False,
                  strict: bool = False, known: DataFrame | None = None, used: int = 0) -> DataFrame:
    """Verdict of every seed row ``(ordinal, url)``.

    ``snapshot`` is the captured fetch log ``(url, status, content_type,
    error, ...)`` keyed by the upgraded URL; any further columns (e.g. the
    extracted page) are carried to the matching rows.

    Output adds ``fetch_url, rule, robots_ok, outcome, ok, prev_ok,
    new_visit, verdict`` (and ``visits_before, pages_crawled_so_far`` with
    ``running_counts``). Verdict precedence: budget, visited, excluded,
    domain, extension, robots, fetch outcome, ok.

    The earliest success per URL is aggregated once (narrow columns only,
    page extraction is pruned from that job) and checkpointed; the budget
    is the ordinal of the ``max_pages``-th new visit, so the verdict needs
    no window over the session rows.

    A session that goes on after another one takes ``known(fetch_url)``, the
    seeds' URLs visited before it, and ``used``, the pages visited so far.
    """
    ensure_checkpoint_dir(seeds.sparkSession)
    s = with_policy(seeds, policy)
    s = robots_allowed(s, robots, policy)
    s = page_fetch(s, snapshot)
    s = s.withColumn("ok", F.col("rule").isNull() & F.col("robots_ok") & (F.col("outcome") == "fetched"))
    first_ok = (s.filter("ok").groupBy("fetch_url")
                .agg(F.min("ordinal").alias("_first_ok"))).checkpoint()
    before = F.lit(False)
    if known is not None:
        known = known.select("fetch_url").distinct()
        first_ok = first_ok.join(known, "fetch_url", "left_anti")
        s = s.join(known.withColumn("_known", F.lit(True)), "fetch_url", "left")
        before = F.coalesce("_known", F.lit(False))
    s = (s.join(first_ok, "fetch_url", "left")
         .withColumn("prev_ok", before | F.coalesce(F.col("ordinal") > F.col("_first_ok"), F.lit(False)))
         .withColumn("new_visit", F.coalesce(F.col("ordinal") == F.col("_first_ok"), F.lit(False)))
         .drop("_first_ok", "_known"))
    over = F.lit(False)
    if policy.max_pages is not None:
        room = policy.max_pages - used
        cutoff = kth_smallest(first_ok, "_first_ok", room) if room > 0 else None
        over = F.lit(True) if room <= 0 else F.lit(False) if cutoff is None else F.col("ordinal") > F.lit(cutoff)
    if running_counts:
        s = running_count_before(s, "new_visit", out="visits_before")
        s = s.withColumn("pages_crawled_so_far", F.col("visits_before") + F.col("new_visit").cast("long"))
    verdict = (F.when(over, F.lit("budget"))
               .when(F.col("prev_ok") & (F.lit(strict) | (F.col("url") == F.col("fetch_url"))), F.lit("visited"))
               .when(F.col("rule").isNotNull(), F.col("rule"))
               .when(~F.col("robots_ok"), F.lit("robots"))
               .when(F.col("outcome") != "fetched", F.col("outcome"))
               .otherwise(F.lit("ok")))
    return s.withColumn("verdict", verdict)


def verdict_detail(policy: CrawlPolicy):
    """Message text of a verdict, as the crawler reports it."""
    v = F.col("verdict")
    return (F.when(v == "budget", F.lit(f"Maximum page limit reached ({policy.max_pages}). Stop crawling."))
            .when(v == "visited", F.lit("URL already visited"))
            .when(v == "excluded", F.lit("Domain is in exclusion list"))
            .when(v == "domain", F.format_string(
                "Domain '%s' is not in the allowed domains list.",
                F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)))
            .when(v == "extension", F.lit("URL points to an excluded file type."))
            .when(v == "robots", F.lit("Blocked by robots.txt"))
            .when(v == "timeout", F.lit("Request timed out"))
            .when(v == "http_error", F.format_string("HTTP error: %d", F.col("status")))
            .when(v == "not_html", F.format_string("Not an HTML page (content-type: %s)",
                                                   F.coalesce("content_type", F.lit(""))))
            .when(v == "not_captured", F.lit("Page not in the captured snapshot"))
            .when(v == "error", F.col("error"))
            .otherwise(F.lit("")))
