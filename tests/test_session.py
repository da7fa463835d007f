"""Visited set and page budget against a sequential replay of the crawler
rules; robots rules on inline cases."""

import random

from pyspark.sql import functions as F

from corpusflow.config import CrawlPolicy
from corpusflow.operators.admission import robots_allowed, with_policy
from corpusflow.operators.session import crawl_session, running_count_before

POOL = [f"{s}://h{i}.example.com/p{j}" for s in ("http", "https") for i in range(3) for j in range(3)]


def replay(urls, outcome, max_pages):
    """Test-only sequential model of the crawler's per-URL checks."""
    visited, out = set(), []
    for u in urls:
        if len(visited) >= max_pages:
            out.append("budget")
            continue
        if u in visited:
            out.append("visited")
            continue
        fu = "https://" + u[7:] if u.startswith("http://") else u
        o = outcome.get(fu, "not_captured")
        if o == "ok":
            visited.add(fu)
        out.append(o)
    return out


def test_window_form_equals_sequential_model(spark):
    rng = random.Random(11)
    pol = CrawlPolicy(allowed_domains=(), respect_robots_txt=False)
    for trial in range(4):
        urls = [rng.choice(POOL) for _ in range(rng.randint(20, 60))]
        outcome = {("https://" + u.split("://")[1]): rng.choice(["ok", "ok", "ok", "http_error"])
                   for u in POOL if rng.random() < 0.9}
        max_pages = rng.randint(2, 8)
        seeds = spark.createDataFrame(list(enumerate(urls)), "ordinal long, url string")
        snap = spark.createDataFrame(
            [(u, 200 if o == "ok" else 500, "text/html", None) for u, o in outcome.items()],
            "url string, status int, content_type string, error string")
        got = [r.verdict for r in crawl_session(seeds, snap, pol.with_(max_pages=max_pages))
               .orderBy("ordinal").collect()]
        assert got == replay(urls, outcome, max_pages), trial


def test_running_count_crosses_blocks(spark):
    rows = [(i * 7919 % 100000, i % 3 == 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "ordinal long, f boolean")
    got = {r.ordinal: r.c for r in running_count_before(df, "f", out="c").collect()}
    run, exp = 0, {}
    for o, f in sorted(rows):
        exp[o] = run
        run += f
    assert got == exp


def test_robots_rule_cases(spark):
    pol = CrawlPolicy(allowed_domains=(), user_agent="MyBot/2.0 (x)")
    rules = spark.createDataFrame([
        ("s401.example.com", 401, None, None, None, None, None),
        ("s404.example.com", 404, None, None, None, None, None),
        ("s503.example.com", 503, None, None, None, None, None),
        ("star.example.com", 200, 0, "*", 0, False, "/private"),
        ("order.example.com", 200, 0, "*", 0, True, "/a"),
        ("order.example.com", 200, 0, "*", 1, False, "/"),
        ("rev.example.com", 200, 0, "*", 0, False, "/"),
        ("rev.example.com", 200, 0, "*", 1, True, "/a"),
        ("own.example.com", 200, 0, "*", 0, False, "/"),
        ("own.example.com", 200, 1, "mybot", 0, False, "/other"),
        ("empty.example.com", 200, 0, "*", 0, False, ""),
    ], "host string, status int, entry_no int, agent string, rule_no int, allow boolean, path_prefix string")
    cases = [
        ("https://none.example.com/x", True), ("https://s401.example.com/", False),
        ("https://s404.example.com/", True), ("https://s503.example.com/", False),
        ("https://star.example.com/private/x", False), ("https://star.example.com/public", True),
        ("https://order.example.com/a/b", True), ("https://order.example.com/b", False),
        ("https://rev.example.com/a/b", False),
        ("https://own.example.com/x", True), ("https://own.example.com/other/1", False),
        ("https://empty.example.com/x", True),
    ]
    df = with_policy(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(cases)], "ordinal long, url string"), pol)
    got = [r.robots_ok for r in robots_allowed(df, rules, pol).orderBy("ordinal").collect()]
    assert got == [e for _, e in cases]
    off = robots_allowed(df, rules, pol.with_(respect_robots_txt=False))
    assert off.filter(~F.col("robots_ok")).count() == 0


def test_spacing_audit_hot_key(spark):
    import datetime as dt
    from corpusflow.operators.reports import spacing_audit
    base = dt.datetime(2024, 1, 1)
    rows = [(i, 0 if i % 3 else i % 7, base + dt.timedelta(milliseconds=137 * i + (i % 5) * 900)) for i in range(3000)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    got = {r.event_id: (r.gap_us, r.too_close) for r in spacing_audit(ev, 1.0, key="user_id", n_ranges=16).collect()}
    last, exp = {}, {}
    for eid, uid, t in sorted(rows, key=lambda x: (x[1], x[2], x[0])):
        us = int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
        gap = None if uid not in last else us - last[uid]
        exp[eid] = (gap, None if gap is None else gap < 1_000_000)
        last[uid] = us
    assert got == exp


def test_spacing_audit_global(spark):
    import datetime as dt
    from corpusflow.operators.reports import spacing_audit
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % 9, base + dt.timedelta(milliseconds=(i * 7919) % 100000)) for i in range(500)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    got = {r.event_id: r.gap_us for r in spacing_audit(ev, 1.0, n_ranges=8).collect()}
    prev, exp = None, {}
    for eid, _, t in sorted(rows, key=lambda x: (x[2], x[0])):
        us = int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
        exp[eid] = None if prev is None else us - prev
        prev = us
    assert got == exp


def test_session_relations_and_counters(spark):
    from corpusflow.operators.extract import page_kind
    from corpusflow.operators.reports import crawl_status, outcome_counts, run_summary, stored_documents, visited_urls
    urls = ["https://a.example.com/1", "http://a.example.com/2", "https://a.example.com/1",
            "http://a.example.com/2", "https://b.example.net/x", "https://a.example.com/404"]
    seeds = spark.createDataFrame(list(enumerate(urls)), "ordinal long, url string")
    long_text, short = "y" * 300, "short"
    snap = spark.createDataFrame([
        ("https://a.example.com/1", 200, "text/html", None, "T1", long_text),
        ("https://a.example.com/2", 200, "text/html", None, "T2", long_text),
        ("https://a.example.com/404", 404, "text/html", None, "", short)],
        "url string, status int, content_type string, error string, title string, content string")
    snap = snap.withColumn("links", F.array().cast("array<struct<url:string,text:string>>"))
    pol = CrawlPolicy(allowed_domains=(".example.com",), respect_robots_txt=False, max_pages=10)
    s = page_kind(crawl_session(seeds, snap, pol), pol)
    assert [r.verdict for r in s.orderBy("ordinal").collect()] == ["ok", "ok", "visited", "ok", "domain", "http_error"]
    assert sorted(r.url for r in visited_urls(s).collect()) == ["https://a.example.com/1", "https://a.example.com/2"]
    stored = [(r.store_order, r.url) for r in stored_documents(s).orderBy("store_order").collect()]
    assert stored == [(1, "https://a.example.com/1"), (2, "https://a.example.com/2"), (3, "https://a.example.com/2")]
    st = crawl_status(s, pol).first()
    assert (st.pages_visited, st.remaining_capacity, st.documents_stored) == (2, 8, 3)
    rs = run_summary(s).first()
    assert (rs.urls_requested, rs.documents_stored, rs.distinct_documents, rs.ingestion_triggered) == (6, 3, 2, True)
    oc = {r.verdict: (r.n, r.n_stored) for r in outcome_counts(s).collect()}
    assert oc == {"ok": (3, 3), "visited": (1, 0), "domain": (1, 0), "http_error": (1, 0)}


def test_running_count_does_not_need_dense_ordinals(spark):
    """Ordinals far apart and negative ones count like dense ones."""
    from corpusflow.operators.session import kth_smallest
    rows = [((-1) ** i * i ** 3 * (1 << 33) + i, i % 2 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "ordinal long, f boolean")
    got = {r.ordinal: r.c for r in running_count_before(df, "f", out="c").collect()}
    order = sorted(rows)
    assert [got[o] for o, _ in order] == [sum(f for _, f in order[:i]) for i in range(len(order))]
    assert kth_smallest(df, "ordinal", 123) == order[122][0]


def test_ordinals_follow_the_order_of_any_payload(spark):
    """One payload of more rows than any fixed stride would hold apart."""
    from corpusflow.operators.session import ordinals
    df = spark.range(1_200_000).select(F.lit(0).cast("long").alias("payload_id"), F.col("id").alias("pos"))
    df = df.unionByName(spark.range(50).select(F.lit(1).cast("long").alias("payload_id"), F.col("id").alias("pos")))
    out = ordinals(df, "payload_id", "pos")
    assert out.select("ordinal").distinct().count() == 1_200_050
    last = out.filter("payload_id = 0").agg(F.max("ordinal")).first()[0]
    assert out.filter("payload_id = 1").agg(F.min("ordinal")).first()[0] > last
    from pyspark.sql import Window
    w = Window.partitionBy(F.spark_partition_id()).orderBy("ordinal")
    assert out.withColumn("d", F.struct("payload_id", "pos") > F.lag(F.struct("payload_id", "pos")).over(w)).filter(~F.col("d")).count() == 0


def test_robots_paths_are_compared_like_the_standard_library(spark):
    from urllib.robotparser import RobotFileParser
    rules = [(True, "/a~b/c"), (False, "/a~b"), (False, "/caf%C3%A9"), (False, "/x y"), (False, "/q?id=1"),
             (False, "/*"), (False, "/100%25"), (True, "/")]
    paths = ["/a%7Eb", "/a~b/c", "/caf%c3%a9/1", "/café", "/cafe", "/x%20y", "/x+y", "/q?id=1&b=2", "/q", "/star",
             "/*star", "/%2Astar", "/100%25", "/100%", "", "?", "/a%2Fb", "/q?id%3D1", "/a%7eb#f"]
    parser = RobotFileParser()
    parser.parse(["User-agent: *"] + [f"{'Allow' if a else 'Disallow'}: {p}" for a, p in rules])
    table = spark.createDataFrame([("h.example.com", 200, 0, "*", i, a, p) for i, (a, p) in enumerate(rules)],
                                  "host string, status int, entry_no int, agent string, rule_no int, allow boolean, path_prefix string")
    urls = [f"https://h.example.com{p}" for p in paths]
    df = with_policy(spark.createDataFrame([(u,) for u in urls], "url string"), CrawlPolicy(allowed_domains=()))
    got = {r.url: r.robots_ok for r in robots_allowed(df, table, CrawlPolicy()).collect()}
    assert got == {u: parser.can_fetch("corpusflowcrawler", u) for u in urls}


def test_only_pages_a_session_can_fetch_are_extracted(spark, tmp_path):
    from corpusflow.plans import crawl
    hosts = ["https://a.example.com/p{}", "http://b.example.org/q{}", "https://spam-farm.example.com/{}",
             "https://other.net/{}", "https://a.example.com/f{}.html", "HTTPS://A.Example.com/u{}"]
    rows = [(i, hosts[i % 6].format(i), f"<html><title>T{i}</title><body><p>{'word ' * (i + 20)}</p></body></html>")
            for i in range(180)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    sf = str(tmp_path)
    ok = crawl.session(spark, sf).filter("verdict = 'ok'").checkpoint()
    cols = ["ordinal", "page_id", "title", "content", "links"]
    got = sorted(map(tuple, crawl.with_pages(ok, spark, sf).select(cols).collect()))
    want = sorted(map(tuple, ok.join(crawl.extracted(spark, sf), "page_id").select(cols).collect()))
    assert got == want and len(got) == ok.count() > 0
    stored = {r[0] for r in crawl.fetched_pages(spark, sf).select("page_id").collect()}
    assert stored == {i for i in range(180) if i % 6 in (0, 1, 5) and i % 10 not in (3, 4) and i % 7 != 5}


def test_strip_looks_at_the_ends_as_python_does(spark):
    from corpusflow.functions.text import py_strip
    every = [chr(i) for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000] + ["\ufeff", "\u200b", "\U0001f600"]
    texts = [f"{c}{c}a{c}b {c}" for c in every] + ["", " ", "\t\n\u3000"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", py_strip(F.col("t")).alias("s"))
    assert all(r.s == r.t.strip() for r in got.collect())
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString()
