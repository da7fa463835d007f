"""Document building: content resolution, file keys, metadata, rendering,
sidecars, store receipts and last-write-wins per file key.

All are projections except ``document_content`` (one equi join with the
page cache) and ``latest_document`` (last order per key, joined back).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CACHE_OVERRIDE_CHARS, NO_CONTENT, CrawlPolicy
from ..functions.text import safe_title
from .session import running_count_before


def document_content(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Resolve the stored content of each store request.

    ``cache(url, content)`` is the page cache keyed by the exact (upgraded)
    URL string. Cached and override empty or shorter than 500 characters ->
    cached content; else the override; an empty override without cache ->
    the no-content marker.
    """
    c = cache.select(F.col("url").alias("_curl"), F.col("content").alias("_cached"))
    j = requests.join(c, requests["url"] == c["_curl"], "left")
    override = F.coalesce(F.col("content"), F.lit(""))
    use_cache = F.col("_curl").isNotNull() & ((override == "") | (F.length(override) < CACHE_OVERRIDE_CHARS))
    resolved = (F.when(use_cache, F.col("_cached"))
                .when(override == "", F.lit(NO_CONTENT))
                .otherwise(override))
    return j.select(*[c for c in requests.columns if c != "content"], resolved.alias("content"),
                    use_cache.alias("from_cache"))


def document_key(title: Column, url: Column) -> Column:
    """``{safe_title}_{md5(url)[:12]}``."""
    return F.concat(safe_title(title), F.lit("_"), F.substring(F.md5(url), 1, 12))


def document_metadata(meta: Column) -> Column:
    """Metadata JSON text: '' -> ``{}``; valid JSON (any value) as is;
    otherwise ``{"raw_metadata": text}``."""
    m = F.coalesce(meta, F.lit(""))
    # keys and numbers stay as written; only white space between tokens goes
    compact = F.regexp_replace(m, r'("(?:[^"\\]|\\.)*")|[ \t\r\n]+', "$1")
    return (F.when(m == "", F.lit("{}"))
            .when(F.try_parse_json(m).isNotNull(), compact)
            .otherwise(F.to_json(F.struct(m.alias("raw_metadata")))))


def iso_utc(ts: Column) -> Column:
    """Python ``datetime.isoformat()`` of an aware UTC time given as a
    ``TIMESTAMP_NTZ`` wall time: fraction only when microseconds are
    non-zero, offset ``+00:00``. Independent of the session time zone."""
    frac = F.date_format(ts, "SSSSSS")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(base, F.when(frac == "000000", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
                    F.lit("+00:00"))


def document_rows(df: DataFrame, crawled_at: str) -> DataFrame:
    """Assemble documents ``(ordinal, filename, source_url, title, content,
    crawled_at, metadata)``; ``crawled_at`` is the run time, UTC wall time."""
    ts = F.to_timestamp_ntz(F.lit(crawled_at))
    return df.select(
        "ordinal",
        document_key(F.col("title"), F.col("url")).alias("filename"),
        F.col("url").alias("source_url"), "title", "content",
        iso_utc(ts).alias("crawled_at"),
        document_metadata(F.col("metadata")).alias("metadata"))


def markdown_body(df: DataFrame) -> Column:
    return F.concat(F.lit("# "), F.col("title"), F.lit("\n\n**Source:** "), F.col("source_url"),
                    F.lit("\n**Crawled:** "), F.col("crawled_at"), F.lit("\n\n---\n\n"),
                    F.col("content"), F.lit("\n"))


def json_body(df: DataFrame) -> Column:
    """JSON object in the document's key order, metadata embedded as JSON."""
    head = F.to_json(F.struct("source_url", "title", "content", "crawled_at"))
    return F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(',"metadata":'), F.col("metadata"), F.lit("}"))


def rendered(docs: DataFrame, policy: CrawlPolicy) -> DataFrame:
    """``(ordinal, filename, key, body)`` in the policy's output format;
    ``key`` is the object key under the policy's prefix."""
    md = policy.output_format == "markdown"
    ext = ".md" if md else ".json"
    return docs.select("ordinal", "filename",
                       F.concat(F.lit(policy.key_prefix), F.col("filename"), F.lit(ext)).alias("key"),
                       (markdown_body(docs) if md else json_body(docs)).alias("body"),
                       "source_url", "title")


def sidecar(docs_rendered: DataFrame) -> DataFrame:
    """Metadata sidecar next to each object: key ``{key}.metadata.json``,
    body with ``source_url`` and ``title`` string attributes excluded from
    embedding."""
    def attr(c):
        return F.struct(F.struct(F.lit("STRING").alias("type"), F.col(c).alias("stringValue")).alias("value"),
                        F.lit(False).alias("includeForEmbedding"))
    body = F.to_json(F.struct(F.struct(attr("source_url").alias("source_url"),
                                       attr("title").alias("title")).alias("metadataAttributes")))
    return docs_rendered.select("ordinal", F.concat("key", F.lit(".metadata.json")).alias("sidecar_key"),
                                body.alias("sidecar"))


def store_receipt(docs_rendered: DataFrame, policy: CrawlPolicy, output_dir: str = "./kb_output") -> DataFrame:
    """Confirmation per store call, with the running total in store order."""
    r = running_count_before(docs_rendered.select("ordinal", "filename", F.lit(True).alias("_one")), "_one",
                             out="_before")
    ext = ".md" if policy.output_format == "markdown" else ".json"
    out = r.select("ordinal", "filename", F.lit(True).alias("stored"),
                   F.concat(F.lit(output_dir.rstrip("/") + "/"), F.col("filename"), F.lit(ext)).alias("local_path"),
                   (F.col("_before") + 1).alias("total_documents_stored"))
    if policy.bucket:
        out = out.withColumn("s3_path", F.concat(F.lit(f"s3://{policy.bucket}/{policy.key_prefix}"),
                                                 F.col("filename"), F.lit(ext)))
    return out.drop("filename")


def latest_document(docs: DataFrame, key: str = "filename", order: str = "ordinal") -> DataFrame:
    """Last write wins per file key: the row with the largest store order
    (unique) and the number of writes. Only (key, order) is aggregated, so no
    body sits in an aggregation buffer and a hot key is cheap."""
    last = docs.groupBy(key).agg(F.max(order).alias(order), F.count(F.lit(1)).alias("writes"))
    return docs.join(last, [key, order]).select(key, *[c for c in docs.columns if c != key], "writes")
