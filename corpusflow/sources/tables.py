"""Readers for the input tables and the crawl-session relations derived
from them.

Every derived relation is plain DataFrame work over the whole input table,
so its size grows with the data; nothing is made up or held on the driver.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import https_upgrade

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; later projections/filters prune columns and push down."""
    return spark.read.parquet(table_path(sf_dir, name))


def _put(x, old, new):
    return F.replace(x, F.lit(old), new if not isinstance(new, str) else F.lit(new))


def odd_markup(html: str = "html", page_id: str = "page_id"):
    """Page markup as browsers get it, by ``page_id`` modulo 7: 1 nested
    boilerplate of one name, 2 and 4 boilerplate that ends with its parent, 3 an
    article and 5 a footer without end tags, 6 an unfinished script."""
    h, r = F.col(html), F.pmod(F.col(page_id), F.lit(7))
    return (F.when(r == 1, _put(h, "<article>", "<aside>before<aside>inner</aside>after</aside><article>"))
            .when(r == 2, _put(h, "<article>", "<div><nav>menu <b>bold</div><article>"))
            .when(r == 3, _put(h, "</article>", ""))
            .when(r == 4, _put(h, "<article>", '<nav/><header class="x"><nav>deep</header><article><noscript>off</article>'))
            .when(r == 5, _put(h, "</article>", "<footer>never closed</article>"))
            .when(r == 6, F.concat(h, F.lit('<script>var a = "<p>"; track('))).otherwise(h))


def varied_html(html: str = "html", page_id: str = "page_id"):
    """Page markup with every case of extraction among the rows, by
    ``page_id`` modulo 5: 1 gets a description with character references, 2 a
    ``main`` around the article, 3 loses its article element, 4 gets 60 relative
    links (more than any cap keeps); 0 stays as it is. Before that, by
    ``page_id`` modulo 7, elements are nested in others of their name or lose
    their end tags (``odd_markup``)."""
    h, i = odd_markup(html, page_id), F.col(page_id)
    put = _put
    meta = F.concat(F.lit('<head><meta content=" Notes &amp; pages &#233; '), i.cast("string"),
                    F.lit(' " name="description">'))
    links = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(
        F.lit('<a href="../x'), k.cast("string"), F.lit("/./y?q="), i.cast("string"), F.lit('&amp;r#"><b>Link</b> '),
        k.cast("string"), F.lit("</a>"))), "")
    r = F.pmod(i, F.lit(5))
    return (F.when(r == 1, put(h, "<head>", meta))
            .when(r == 2, put(put(h, "<article>", "<main><article>"), "</article>", "</article></main>"))
            .when(r == 3, put(put(h, "<article>", "<div>"), "</article>", "</div>"))
            .when(r == 4, put(h, "</article>", F.concat(links, F.lit("</article>")))).otherwise(h))


def page_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, pos, to)``: page i leads to pages 2i+1 and 2i+2 (unless
    multiples of 7) and, if i is a multiple of 5, back to its parent; pages
    whose id leaves remainder 2 modulo 3 lead nowhere."""
    i = F.col("page_id")

    def child(c):
        return F.when(c % 7 != 0, c)
    pages = read_table(spark, sf_dir, "pages").select("page_id")
    out = pages.filter(i % 3 != 2).select("page_id", F.posexplode(F.array(
        child(i * 2 + 1), child(i * 2 + 2), F.when((i % 5 == 0) & (i > 0), F.floor((i - 1) / 2)).cast("long"))).alias("pos", "to"))
    return out.join(pages.withColumnRenamed("page_id", "to"), "to", "left_semi")


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` whose markup links to other pages: pages that lead anywhere
    (``page_edges``) are short tables of contents, the others keep their text."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    named = page_edges(spark, sf_dir).join(pages.select(F.col("page_id").alias("to"), "url"), "to")
    anchor = F.concat(F.lit('<li><a href="'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('">part '),
                      F.col("to").cast("string"), F.lit("</a></li>"))
    lists = named.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("pos", anchor.alias("a")))).alias("l"))
    body = F.concat(F.lit("<html><head><title>Contents</title></head><body><h1>Contents</h1><ul>"),
                    F.array_join(F.transform("l", lambda x: x["a"]), ""), F.lit("</ul></body></html>"))
    return pages.join(lists, "page_id", "left").select("page_id", "url", F.coalesce(body, "html").alias("html"))


def captured_as(page_id: str = "page_id") -> dict:
    """``status``, ``content_type`` and ``error`` of a page's capture, by a fixed
    rule on ``page_id``: 404 for ids ending in 3, a timeout for ids ending in 4,
    a PDF body for ids with remainder 5 modulo 7, HTML otherwise."""
    d10 = F.col(page_id) % 10
    return {"status": F.when(d10 == 3, F.lit(404)).when(d10 == 4, F.lit(None)).otherwise(F.lit(200)).cast("int"),
            "content_type": F.when(F.col(page_id) % 7 == 5, F.lit("application/pdf"))
            .otherwise(F.lit("text/html; charset=utf-8")),
            "error": F.when(d10 == 4, F.lit("timeout"))}


def fetch_log(spark: SparkSession, sf_dir: str, transform=None, pages: DataFrame | None = None) -> DataFrame:
    """Captured fetch snapshot ``(url, page_id, status, content_type, error,
    html)`` keyed by the upgraded URL, one row per URL (lowest page_id).

    The live GET of the crawler is re-aimed as a join with this snapshot.
    Status and content type are assigned by ``captured_as``.

    ``transform`` (e.g. page extraction) is applied before the per-URL
    dedupe, so the dedupe join moves the transformed rows (bounded text)
    instead of raw HTML. The dedupe key table holds only (url, page_id).
    ``pages`` takes the place of the table's pages and their variants.
    """
    from ..session import spread
    html = varied_html() if pages is None else F.col("html")
    pages = read_table(spark, sf_dir, "pages") if pages is None else pages
    p = spread(pages).select(
        https_upgrade(F.col("url")).alias("url"), "page_id",
        *[c.alias(name) for name, c in captured_as().items()], html.alias("html"))
    if transform is not None:
        p = transform(p)
    first = (pages.select(https_upgrade(F.col("url")).alias("url"), "page_id")
             .groupBy("url").agg(F.min("page_id").alias("page_id")))
    return p.join(first, ["url", "page_id"], "left_semi")


ORDINAL_STRIDE = 1 << 40   # ordinal = pass * stride + page_id


def session_seeds(spark: SparkSession, sf_dir: str, passes: int = 2) -> DataFrame:
    """Seed list ``(ordinal, url)``: every page in page_id order, the whole
    list submitted ``passes`` times, so repeats (already visited, http
    re-fetch) occur for every URL. The ordinal of pass ``k`` is
    ``k * 2**40 + page_id``, so no global numbering pass is needed."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    parts = [pages.select((F.col("page_id") + F.lit(k * ORDINAL_STRIDE)).alias("ordinal"), "url")
             for k in range(passes)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def crawl_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl request payloads ``(payload_id, payload)``, two per page.

    Even ids use the array form ``{"urls": [url]}``; odd ids use the legacy
    prompt form, a comma/newline separated text holding the page URL twice
    and a non-URL word (which the prompt parser drops).
    """
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    arr = pages.select((F.col("page_id") * 2).alias("payload_id"),
                       F.to_json(F.struct(F.array("url").alias("urls"))).alias("payload"))
    prompt = pages.select(
        (F.col("page_id") * 2 + 1).alias("payload_id"),
        F.to_json(F.struct(F.concat(F.lit("crawl, "), F.col("url"), F.lit(",\n  "),
                                    F.col("url"), F.lit("\n")).alias("prompt"))).alias("payload"))
    return arr.unionByName(prompt)


def robots_rules(spark: SparkSession, sf_dir: str, agent_token: str) -> DataFrame:
    """Robots rules for every host of ``pages``, assigned by a fixed rule on
    the md5 of the host name (first hex digit: 0 -> 401, 1 -> 404,
    2 -> 503, else 200 with a ``*`` entry disallowing ``/fr``; second hex
    digit 0-7 adds an entry for our agent (allow ``/fr/1``, then disallow
    ``/fr``, then an empty disallow), 8-b adds an entry for another agent
    disallowing everything).
    """
    from ..functions.urls import netloc
    hosts = (read_table(spark, sf_dir, "pages")
             .select(netloc(https_upgrade(F.col("url"))).alias("host")).distinct())
    h = F.md5("host")
    c0, c1 = F.substring(h, 1, 1), F.substring(h, 2, 1)
    status = (F.when(c0 == "0", 401).when(c0 == "1", 404).when(c0 == "2", 503)
              .otherwise(200).cast("int"))

    def line(entry, agent, rule, allow, prefix):
        return F.struct(F.lit(entry).cast("int").alias("entry_no"), F.lit(agent).cast("string").alias("agent"),
                        F.lit(rule).cast("int").alias("rule_no"), F.lit(allow).cast("boolean").alias("allow"),
                        F.lit(prefix).cast("string").alias("path_prefix"))
    star = F.array(line(0, "*", 0, False, "/fr"))
    own = F.array(line(1, agent_token, 0, True, "/fr/1"), line(1, agent_token, 1, False, "/fr"),
                  line(1, agent_token, 2, False, ""))
    other = F.array(line(1, "otherbot", 0, False, "/"))
    failed = F.array(line(None, None, None, None, None))
    lines = (F.when(status != 200, failed)
             .when(c1 < "8", F.concat(star, own))
             .when(c1 < "c", F.concat(star, other))
             .otherwise(star))
    return (hosts.select("host", status.alias("status"), F.explode(lines).alias("l"))
            .select("host", "status", "l.entry_no", "l.agent", "l.rule_no", "l.allow", "l.path_prefix"))


def toc_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link relation ``(page_url, pos, link_url)`` derived from ``pages``:
    page i links to pages 2i+1 and 2i+2 when they exist and are not
    multiples of 7 (those start trees of their own, so the graph is a
    forest with many roots), and pages with i % 5 == 0 (i > 0) also link
    back to their parent, making cycles. URLs are the raw ``pages.url``."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    src = pages.select(F.col("page_id").alias("src_id"), F.col("url").alias("page_url"))
    tgt = pages.select(F.col("page_id").alias("dst_id"), F.col("url").alias("link_url"))
    i = F.col("src_id")

    def child(c):
        return F.when(c % 7 != 0, c)
    edges = src.select("page_url", F.explode(F.array(
        F.struct(child(i * 2 + 1).alias("dst_id"), F.lit(0).alias("pos")),
        F.struct(child(i * 2 + 2).alias("dst_id"), F.lit(1).alias("pos")),
        F.struct(F.when((i % 5 == 0) & (i > 0), F.floor((i - 1) / 2)).cast("long").alias("dst_id"),
                 F.lit(2).alias("pos")))).alias("e"))
    return (edges.select("page_url", F.col("e.dst_id").alias("dst_id"), F.col("e.pos").alias("pos"))
            .join(tgt, "dst_id").select("page_url", "pos", "link_url"))


def dense_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``toc_links`` and, for every eleventh page, links to the 60 pages after
    it (positions 3 to 62), more than any cap per page keeps."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    src = pages.filter(F.pmod("page_id", F.lit(11)) == 0).select(
        F.col("url").alias("page_url"), F.explode(F.transform(
            F.sequence(F.lit(1), F.lit(60)), lambda k: F.struct(
                (F.col("page_id") + k).alias("dst_id"), (k + 2).alias("pos")))).alias("e"))
    more = src.select("page_url", "e.pos", F.col("e.dst_id").alias("page_id")).join(
        pages.withColumnRenamed("url", "link_url"), "page_id").select("page_url", "pos", "link_url")
    return toc_links(spark, sf_dir).unionByName(more)


def doc_url(source: str = "source", doc_id: str = "doc_id"):
    return F.concat(F.lit("https://"), F.col(source), F.lit(".example.org/doc/"), F.col(doc_id).cast("string"))


def store_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store calls ``(ordinal, url, title, content, metadata)`` derived from
    ``documents``; every document is stored twice (second pass with an empty
    content override), so each file key is written twice.

    Fixed assignment rules on doc_id: ids divisible by 5 use the raw
    ``http://`` URL (which misses the page cache); the first-pass override
    is empty / the first 499 characters / the full text for remainders
    0 / 1 / 2 modulo 3; metadata is empty / a JSON object / a JSON array /
    invalid JSON for remainders 0 / 1 / 2 / 3 modulo 4. The title is the
    first line cut to 60 characters.
    """
    d = read_table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    url = F.when(i % 5 == 0, F.concat(F.lit("http://"), F.col("source"), F.lit(".example.org/doc/"),
                                       i.cast("string"))).otherwise(doc_url())
    title = F.substring(F.substring_index(F.col("text"), "\n", 1), 1, 60)
    override = F.when(i % 3 == 0, F.lit("")).when(i % 3 == 1, F.substring("text", 1, 499)).otherwise(F.col("text"))
    meta = (F.when(i % 4 == 0, F.lit(""))
            .when(i % 4 == 1, F.to_json(F.struct("lang", "source")))
            .when(i % 4 == 2, F.to_json(F.array("lang", "source")))
            .otherwise(F.concat(F.lit("lang="), F.col("lang"))))
    base = d.select(i.alias("doc_id"), url.alias("url"), title.alias("title"), override.alias("content"),
                    meta.alias("metadata"))
    first = base.withColumn("ordinal", F.col("doc_id"))
    second = base.withColumn("ordinal", F.col("doc_id") + F.lit(ORDINAL_STRIDE)).withColumn("content", F.lit(""))
    return first.unionByName(second).select("ordinal", "doc_id", "url", "title", "content", "metadata")


def page_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page cache ``(url, content)`` keyed by the upgraded URL: every
    document except the German ones (which were never fetched)."""
    d = read_table(spark, sf_dir, "documents")
    return d.filter(F.col("lang") != "de").select(doc_url().alias("url"), F.col("text").alias("content"))
