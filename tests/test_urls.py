"""URL admission rules, upgrade, preflight and seed parsing on inline
fixtures (the demo URL list and the URL quirks table)."""

import json

from pyspark.sql import functions as F

from corpusflow.config import CrawlPolicy
from corpusflow.functions.urls import https_upgrade, netloc, preflight_marker, resolve_url, url_path
from corpusflow.operators.admission import policy_rule
from corpusflow.operators.seeds import seed_urls
from corpusflow.operators.session import crawl_session

DEFAULT = CrawlPolicy()

# The demo submission list, in order.
DEMO_URLS = [
    "https://www.csagroup.org/wp-content/uploads/2430328.pdf",
    "https://laws-lois.justice.gc.ca/eng/ACTS/L-2/index.html",
    "https://laws-lois.justice.gc.ca/eng/regulations/sor-86-304/index.html",
    "https://laws-lois.justice.gc.ca/eng/acts/h-6/",
    "https://laws-lois.justice.gc.ca/eng/acts/p-38.2/",
    "https://laws-lois.justice.gc.ca/eng/acts/P-38.2/page-1.html",
    "https://www.tbs-sct.canada.ca/pol/doc-eng.aspx?id=32691",
    "https://laws-lois.justice.gc.ca/eng/acts/G-6/",
    "https://laws-lois.justice.gc.ca/eng/regulations/C.R.C.,_c._887/",
    "https://www.tbs-sct.canada.ca/pol/doc-eng.aspx?id=32593",
    "https://www.tbs-sct.canada.ca/pol/doc-eng.aspx?id=32621",
    "https://www.tbs-sct.gc.ca/pol/doc-eng.aspx?id=12614&section=HTML",
    "https://publications.gc.ca/collections/collection_2022/cnrc-nrc/NR24-28-2020-eng.pdf",
    "https://www.tbs-sct.canada.ca/pol/doc-eng.aspx?id=32692",
]


def _rules(spark, urls, policy=DEFAULT):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "ordinal long, url string")
    return [r["rule"] for r in df.select("ordinal", policy_rule(F.col("url"), policy).alias("rule"))
            .orderBy("ordinal").collect()]


def test_demo_golden_admission(spark):
    got = _rules(spark, DEMO_URLS)
    expected = ["domain"] + [None] * 11 + ["extension", None]
    assert got == expected


def test_demo_preflight(spark):
    df = spark.createDataFrame([(u,) for u in DEMO_URLS], "url string")
    marks = [r[0] for r in df.select(preflight_marker(F.col("url"))).collect()]
    assert marks.count("PDF") == 2 and marks.count("Non-GC domain") == 0


def test_hash_goldens(spark):
    df = spark.createDataFrame([(DEMO_URLS[i],) for i in (1, 6, 8)], "url string")
    got = [r[0] for r in df.select(F.substring(F.md5("url"), 1, 12)).collect()]
    assert got == ["e545a1876b95", "5222116b75eb", "83e4bab18d95"]


def test_url_quirks(spark):
    cases = [
        ("https://canada.ca/x", "domain"),
        ("https://a.gc.ca:8080/x", "domain"),
        ("https://A.GC.CA/X", None),
        ("https://notfacebook.com.gc.ca/", "excluded"),
        ("https://a.gc.ca/x.PDF;v=1?q=1#f", "extension"),
        ("https://a.gc.ca/x?f=y.pdf", None),
        ("https://a.gc.ca/x y.pdf", "extension"),
        ("https://a_b.gc.ca/x", None),
        ("HTTP://a.gc.ca/x", None),
    ]
    assert _rules(spark, [u for u, _ in cases]) == [e for _, e in cases]


def test_split_and_upgrade(spark):
    df = spark.createDataFrame([("http://u:p@Host.GC.ca:81/A/b;p?q#f",), ("HTTP://x.gc.ca/",)], "url string")
    r = df.select(netloc(F.col("url")), url_path(F.col("url")), https_upgrade(F.col("url"))).collect()
    assert tuple(r[0]) == ("u:p@host.gc.ca:81", "/a/b", "https://u:p@Host.GC.ca:81/A/b;p?q#f")
    assert r[1][2] == "HTTP://x.gc.ca/"  # case-sensitive upgrade


def test_resolve_url_matches_urljoin(spark):
    from urllib.parse import urljoin
    base = "https://a.example.com/en/dir/page?x=1#top"
    hrefs = ["https://b.example.org/z", "//c.example.net/y", "/root/p", "x/../y", "../up", "./same",
             "?q=2", "#frag", "", "mailto:a@b", "http://plain.example.com/", "deep/er/", "/a/./b/../c"]
    df = spark.createDataFrame([(h,) for h in hrefs], "href string")
    got = [r[0] for r in df.select(resolve_url(F.lit(base), F.col("href"))).collect()]
    assert got == [urljoin(base, h) for h in hrefs]


def test_seed_urls_array_vs_prompt(spark):
    comma_url = DEMO_URLS[8]   # contains a comma
    payloads = [
        (0, json.dumps({"urls": [comma_url, DEMO_URLS[1]]})),
        (1, json.dumps({"prompt": f"{comma_url}\n {DEMO_URLS[1]} , notaurl"})),
        (2, json.dumps({"urls": [], "prompt": ""})),
    ]
    df = spark.createDataFrame(payloads, "payload_id long, payload string")
    rows = sorted(seed_urls(df).collect(), key=lambda r: (r.payload_id, r.pos))
    by = {}
    for r in rows:
        by.setdefault(r.payload_id, []).append(r.url)
    assert by[0] == [comma_url, DEMO_URLS[1]]
    # the prompt form splits on the comma inside the URL
    assert by[1] == ["https://laws-lois.justice.gc.ca/eng/regulations/C.R.C.", DEMO_URLS[1]]
    assert by[2] == [None]


def test_visited_raw_vs_upgraded(spark):
    urls = ["http://a.gc.ca/x", "http://a.gc.ca/x", "https://a.gc.ca/y", "https://a.gc.ca/y", "HTTP://a.gc.ca/z"]
    seeds = spark.createDataFrame(list(enumerate(urls)), "ordinal long, url string")
    snap = spark.createDataFrame(
        [(u, 200, "text/html", None) for u in ("https://a.gc.ca/x", "https://a.gc.ca/y", "HTTP://a.gc.ca/z")],
        "url string, status int, content_type string, error string")
    s = crawl_session(seeds, snap, DEFAULT.with_(respect_robots_txt=False)).orderBy("ordinal").collect()
    assert [r.verdict for r in s] == ["ok", "ok", "ok", "visited", "ok"]
    assert [r.new_visit for r in s] == [True, False, True, False, True]
    assert s[4].fetch_url == "HTTP://a.gc.ca/z"


def test_visited_strict_option(spark):
    urls = ["http://a.gc.ca/x", "http://a.gc.ca/x"]
    seeds = spark.createDataFrame(list(enumerate(urls)), "ordinal long, url string")
    snap = spark.createDataFrame([("https://a.gc.ca/x", 200, "text/html", None)],
                                 "url string, status int, content_type string, error string")
    pol = DEFAULT.with_(respect_robots_txt=False)
    s = crawl_session(seeds, snap, pol, strict=True).orderBy("ordinal").collect()
    assert [r.verdict for r in s] == ["ok", "visited"]
