"""The stack fold against a DOM walk on broken markup."""

import random

from conftest import SF_CHECK
from corpusflow.config import TEST_POLICY
from corpusflow.functions.html import RAW_TEXT_TAGS, VOID_TAGS
from corpusflow.operators.extract import extract_pages
from corpusflow.sources import tables as T
from test_extract import VOID, walk

POL = TEST_POLICY.with_(max_content_length=10 ** 9)
NAMES = ["div", "p", "b", "ul", "nav", "aside", "header", "footer", "noscript", "article", "main", "body", "NAV", "Aside"]


def page(rng, n):
    """Tags in any order, many without a partner."""
    out, k = [], 0
    for _ in range(n):
        k += 1
        name = rng.choice(NAMES)
        out.append(rng.choices([
            f"<{name}>", f'<{name} class="a>b">', f"</{name}>", f"</{name} >", f"<{name}/>", "<br>", "<img src='x>'>",
            "<!-- <nav> -->", "<script>var a = '<nav>'; </script>", "<style>nav{}</style>", "<script/>"],
            [8, 2, 8, 1, 1, 1, 1, 1, 1, 1, 1])[0])
        if rng.random() < .6:
            out.append(f"text{k} ")
    return "".join(out) + rng.choice(["", "", "<script>x = '</nav>'"])


def contents(spark, pages, policy=POL):
    df = spark.createDataFrame([(i, "https://a.example.com/p", h) for i, h in enumerate(pages)],
                               "page_id long, url string, html string")
    return {r.page_id: r.content for r in extract_pages(df, policy).select("page_id", "content").collect()}


def test_broken_pages_equal_a_dom_walk(spark):
    rng = random.Random(17)
    pages = [page(rng, rng.randint(1, 60)) for _ in range(600)]
    got = contents(spark, pages)
    bad = [p for i, p in enumerate(pages) if walk(p)[1] != got[i]]
    assert not bad, (len(bad), bad[0], walk(bad[0])[1], got[pages.index(bad[0])])


def test_nested_and_unclosed_boilerplate(spark):
    pages = ["<aside>x<aside>y</aside>LEAK</aside>kept", "<div><nav>menu LEAK</div>kept",
             "<article>in<p>side</body>out", "a<nav>b<article>c</nav>d", "</nav>a</article>b<nav/>c",
             "<body><article>a<footer>b</article>c</body>", "<main>a<main>b</main>c</main>d", "x<script>y", ""]
    got = contents(spark, pages)
    assert [got[i] for i in range(len(pages))] == [
        "kept", "kept", "in\nside\nout", "a\nd", "a\nb\nc", "a", "a\nb\nc", "x", ""]


def test_long_page_is_one_pass(spark):
    pages = ["<p>t" * 4000, "<nav>a</nav>b" * 2000, "<div>" * 1500 + "deep" + "</div>" * 1500]
    got = contents(spark, pages)
    assert got == {i: walk(p)[1] for i, p in enumerate(pages)}


def test_derived_pages_equal_a_dom_walk(spark):
    """Every variant of the registered queries' pages."""
    pages = T.read_table(spark, SF_CHECK, "pages").withColumn("html", T.varied_html())
    got = {r.page_id: (r.title, r.content) for r in extract_pages(pages, POL).select("page_id", "title", "content").collect()}
    html = {r.page_id: r.html for r in pages.select("page_id", "html").collect()}
    assert [i for i, h in html.items() if walk(h) != got[i]] == []


def test_element_types_cover_the_walk():
    assert VOID <= set(VOID_TAGS) and not set(RAW_TEXT_TAGS) & set(VOID_TAGS)


def test_page_that_holds_the_mark(spark):
    from corpusflow.functions.html import PIECE
    pages = [f"a{PIECE}<nav>x</nav>b{PIECE}c", f"<aside>{PIECE}</aside>d"]
    assert contents(spark, pages) == {i: walk(p)[1] for i, p in enumerate(pages)}
