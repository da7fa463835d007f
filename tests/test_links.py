"""Link caps and the breadth-first TOC expansion against a Python BFS."""

from collections import deque

from pyspark.sql import functions as F

from corpusflow.config import CrawlPolicy
from corpusflow.operators.links import link_limits, toc_expand, unvisited_links

POL = CrawlPolicy(allowed_domains=(".example.com",), excluded_extensions=(".pdf",))


def test_unvisited_and_limits(spark):
    links = ([("https://p.example.com/a", i, f"https://p.example.com/l{i}") for i in range(60)]
             + [("https://p.example.com/t", i, f"https://q.example.com/s{i}") for i in range(25)]
             + [("https://p.example.com/t", 25, "http://q.example.com/s0"),
                ("https://p.example.com/t", 26, "https://q.example.com/x.pdf")])
    ldf = spark.createDataFrame(links, "page_url string, pos int, link_url string")
    visited = spark.createDataFrame([("https://q.example.com/s0",)], "url string")
    un = unvisited_links(ldf, visited)
    assert un.filter(F.col("link_url") == "https://q.example.com/s0").count() == 0
    assert un.filter(F.col("link_url") == "http://q.example.com/s0").count() == 1  # raw http never matches
    got = {r.page_url: r for r in link_limits(ldf, visited, POL).collect()}
    a, t = got["https://p.example.com/a"], got["https://p.example.com/t"]
    assert (a.links_found, a.n_sample, a.link_count, a.n_follow) == (50, 5, 50, 20)
    assert (t.links_found, t.link_count, t.n_follow) == (27, 25, 20)


def test_toc_expand_cycles_against_bfs(spark):
    pages = [f"https://h.example.com/{i}" for i in range(30)]
    edges = []
    for i in range(30):
        for pos, j in enumerate((2 * i + 1, 2 * i + 2)):
            if j < 30:
                edges.append((pages[i], pos, pages[j]))
        if i % 4 == 0 and i > 0:
            edges.append((pages[i], 2, pages[(i - 1) // 2]))   # cycle back to the parent
    thin = {p for k, p in enumerate(pages) if k % 3 != 2}
    ldf = spark.createDataFrame(edges, "page_url string, pos int, link_url string")
    toc = spark.createDataFrame([(p,) for p in thin], "url string")
    seeds = spark.createDataFrame([(pages[0],)], "url string")
    got = {r.url: r.depth for r in toc_expand(seeds, toc, ldf, POL).collect()}
    depth, qd = {pages[0]: 0}, deque([pages[0]])
    while qd:
        u = qd.popleft()
        if u not in thin:
            continue
        for p, _, v in sorted(edges, key=lambda e: e[1]):
            if p == u and v not in depth:
                depth[v] = depth[u] + 1
                qd.append(v)
    assert got == depth
    capped = {r.url for r in toc_expand(seeds, toc, ldf, POL, max_depth=1).collect()}
    assert capped == {u for u, d in depth.items() if d <= 1}
