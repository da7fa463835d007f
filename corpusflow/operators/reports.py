"""Session reports and request spacing.

Reports are aggregates with map-side partial aggregation; none gathers the
rows of a session into one group. Lists the crawler prints (visited URLs,
stored documents) stay relations (``visited_urls``, ``stored_documents``)
instead of one unbounded array in a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import CrawlPolicy
from .session import running_count_before


def stored_flag(df: DataFrame):
    """A store call happens for every ok fetch of a substantive page
    (re-fetched ``http`` URLs are stored again)."""
    return (F.col("verdict") == "ok") & (F.col("kind") == "ok")


def visited_urls(session: DataFrame) -> DataFrame:
    return session.filter("new_visit").select(F.col("fetch_url").alias("url"), "ordinal")


def stored_documents(session: DataFrame) -> DataFrame:
    """Store log in store order: ``(store_order, ordinal, title, url)``."""
    stored = session.filter(stored_flag(session)).select("ordinal", "title", F.col("fetch_url").alias("url"),
                                                         F.lit(True).alias("_stored"))
    s = running_count_before(stored, "_stored", out="_before")
    return s.select((F.col("_before") + 1).alias("store_order"), "ordinal", "title", "url")


def outcome_urls(session: DataFrame) -> DataFrame:
    """The URLs behind each outcome: ``(verdict, url)``, each pair once."""
    return session.select("verdict", F.col("fetch_url").alias("url")).distinct()


def crawl_status(session: DataFrame, policy: CrawlPolicy) -> DataFrame:
    """``pages_visited, max_pages, remaining_capacity, documents_stored``."""
    agg = session.agg(F.count_if(F.col("new_visit")).alias("pages_visited"),
                      F.count_if(stored_flag(session)).alias("documents_stored"))
    return agg.select("pages_visited", F.lit(policy.max_pages).cast("long").alias("max_pages"),
                      (F.lit(policy.max_pages) - F.col("pages_visited")).cast("long").alias("remaining_capacity"),
                      "documents_stored")


def run_summary(session: DataFrame) -> DataFrame:
    """``urls_requested, documents_stored, distinct_documents,
    ingestion_triggered`` (an ingestion run follows only if something was
    stored). A session has one row per submitted URL."""
    return (session.agg(
        F.count(F.lit(1)).alias("urls_requested"),
        F.count_if(stored_flag(session)).alias("documents_stored"),
        F.count_distinct(F.when(stored_flag(session), F.col("fetch_url"))).alias("distinct_documents"))
        .withColumn("ingestion_triggered", F.col("documents_stored") > 0))


def outcome_counts(session: DataFrame) -> DataFrame:
    """Per verdict: rows, distinct URLs, and store calls."""
    return (session.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("fetch_url").alias("n_urls"),
        F.count_if(stored_flag(session)).alias("n_stored")))


def request_schedule(session: DataFrame, policy: CrawlPolicy) -> DataFrame:
    """Planned request times: rows that reach the fetch step get consecutive
    slots in seed order, ``request_delay`` apart (a plan instead of sleep)."""
    reach = ~F.col("verdict").isin("budget", "visited", "excluded", "domain", "extension", "robots")
    req = session.filter(reach).select("ordinal", "fetch_url", F.lit(True).alias("_req"))
    s = running_count_before(req, "_req", out="slot")
    return (s.select("ordinal", "fetch_url", "slot",
                                    (F.col("slot") * F.lit(int(policy.request_delay * 1_000_000)))
                                    .cast("long").alias("start_offset_us")))


def epoch_micros(ts):
    """Microseconds since 1970-01-01 of a ``TIMESTAMP_NTZ`` wall time,
    computed from its parts, so no session time zone is involved."""
    sec = F.extract(F.lit("SECOND"), ts)
    return (F.unix_date(F.to_date(ts)).cast("long") * 86_400_000_000
            + F.hour(ts).cast("long") * 3_600_000_000 + F.minute(ts).cast("long") * 60_000_000
            + (sec * 1_000_000).cast("long"))


def spacing_audit(events: DataFrame, delay_s: float, key: str | None = None,
                  ts: str = "ts", tie: str = "event_id", n_ranges: int | None = None) -> DataFrame:
    """Gap to the previous request and whether it is below the minimum
    delay (``gap_us`` null for the first request). ``key=None`` is the
    crawler's rule, one gap over all requests; a key column (e.g. a host)
    audits each key separately.

    The previous row is found without gathering a key into one task, even
    if one key holds a third of all rows: rows are range-partitioned on
    (key, time, tie) — Spark samples the boundaries, so a hot key spans
    many partitions — and tagged with their partition id, checkpointed so
    the tagging is fixed. ``lag`` then runs per (partition, key); the first
    row of each piece takes its predecessor from the last time of the
    previous piece of the same key, found on the small per-(partition, key)
    table.
    """
    from ..session import ensure_checkpoint_dir, shuffle_partitions
    spark = events.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_ranges or shuffle_partitions(spark)
    if key is None:   # one global order: every row in the same (hot) group
        events, key = events.withColumn("_all", F.lit(0)), "_all"
    e = events.select(key, tie, epoch_micros(F.col(ts)).alias("_us"))
    r = (e.repartitionByRange(n, key, "_us", tie)
         .withColumn("_pid", F.spark_partition_id()).checkpoint())
    inner = F.lag("_us").over(Window.partitionBy("_pid", key).orderBy("_us", tie))
    pieces = r.groupBy("_pid", key).agg(F.max("_us").alias("_last"))
    carry = pieces.select("_pid", key, F.lag("_last").over(
        Window.partitionBy(key).orderBy("_pid")).alias("_carry"))
    j = r.withColumn("_prev", inner).join(carry, ["_pid", key], "left")
    gap = F.col("_us") - F.coalesce(F.col("_prev"), F.col("_carry"))
    out = j.select(tie, key, gap.alias("gap_us"), (gap < F.lit(int(delay_s * 1_000_000))).alias("too_close"))
    return out.drop("_all")
