"""Extraction: inline HTML quirks, and a cross-check of the native column
expressions against a DOM walk built on the standard-library HTML parser
over every page of the sf0.01 table."""

from html.parser import HTMLParser

from pyspark.sql import functions as F

from conftest import SF_CHECK
from corpusflow.config import TEST_POLICY, CrawlPolicy
from corpusflow.operators.extract import extract_pages, page_kind

BOILER = {"script", "style", "nav", "footer", "header", "aside", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def _names():
    from html.entities import html5
    out = {}
    for k, v in sorted(html5.items()):
        out.setdefault(k[:-1] if k.endswith(";") else k, v)
    return out


NAMES = _names()


def entity_text(name):
    """Reference handlers of the parser the crawler used (test-only)."""
    return NAMES.get(name, "&" + name)


def charref_text(name):
    n = int(name[1:], 16) if name[:1] in "xX" else int(name)
    data = None
    if n < 256:
        try:
            data = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            pass
    if not data:
        try:
            data = chr(n)
        except (ValueError, OverflowError):
            pass
    return data or "\ufffd"


class Walker(HTMLParser):
    """Test-only DOM walk: text nodes with the ids of their open elements."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.stack, self.nodes, self.first, self.n = [], [], {}, 0
        self.buf = []

    def _flush(self):
        if self.buf:
            self.nodes.append(("".join(self.buf), tuple(self.stack)))
            self.buf = []

    def handle_entityref(self, name):
        self.buf.append(entity_text(name))

    def handle_charref(self, name):
        self.buf.append(charref_text(name))

    def handle_comment(self, data):
        self._flush()

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in VOID:
            return
        self.n += 1
        inside_boiler = any(t in BOILER for t, _ in self.stack)
        if not inside_boiler and tag not in self.first:
            self.first[tag] = self.n
        self.stack.append((tag, self.n))

    def handle_endtag(self, tag):
        self._flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.buf.append(data)


def walk(html):
    w = Walker()
    w.feed(html)
    w.close()
    w._flush()
    visible = [(d, st) for d, st in w.nodes if not any(t in BOILER for t, _ in st)]
    title = ""
    if "title" in w.first:
        inside = [d for d, st in visible if any(i == w.first["title"] for _, i in st)]
        if len(inside) == 1:
            title = inside[0].strip()
    for tag in ("main", "article", "body"):
        if tag in w.first:
            region = [d for d, st in visible if any(i == w.first[tag] for _, i in st)]
            break
    else:
        region = [d for d, _ in visible]
    lines = [ln.strip() for d in region for ln in d.strip().splitlines() if ln.strip()]
    return title, "\n".join(lines)


def test_cross_check_with_dom_walk(spark):
    pages = spark.read.parquet(f"{SF_CHECK}/pages.parquet")
    pol = TEST_POLICY.with_(max_content_length=10 ** 9)
    got = {r.page_id: (r.title, r.content) for r in
           extract_pages(pages, pol).select("page_id", "title", "content").collect()}
    htmls = {r.page_id: r.html for r in pages.select("page_id", "html").collect()}
    bad = [pid for pid, h in htmls.items() if walk(h) != got[pid]]
    assert not bad, bad[:5]


def _one(spark, html, url="https://a.example.com/p", policy=TEST_POLICY, tags=None):
    df = spark.createDataFrame([(url, html)], "url string, html string")
    return extract_pages(df, policy, tags=tags).collect()[0]


def test_title_cases(spark):
    assert _one(spark, "<html><body><p>x</p></body></html>").title == ""
    assert _one(spark, "<title> A &amp; B &quot;c&quot; and&amp</title>").title == 'A & B "c" and&'
    assert _one(spark, "<header><title>T</title></header><p>x</p>").title == ""
    assert _one(spark, "<title>a<b>b</b></title>").title == ""


def test_meta_description(spark):
    r = _one(spark, '<head><meta content=" D1 " name="description"><meta name="description" content="D2"></head>')
    assert r.meta_description == "D1"
    assert _one(spark, '<meta name="Description" content="x">').meta_description == ""
    assert _one(spark, "<meta name='description' content='single'>").meta_description == "single"


def test_main_wins_even_empty(spark):
    r = _one(spark, "<body><main></main><article><p>Full text</p></article></body>")
    assert r.content == ""
    r = _one(spark, "<body><div>top</div><article><p>A</p></article></body>")
    assert r.content == "A"
    assert _one(spark, "<p>no body</p><p>two</p>").content == "no body\ntwo"


def test_text_nodes_and_lines(spark):
    r = _one(spark, "<body>a<b>b</b>c<!-- note -->d<script>var x='</p>';</script>e\n\n  f  </body>")
    assert r.content == "a\nb\nc\nd\ne\nf"
    r = _one(spark, "<body><article><p>unclosed region")
    assert r.content == "unclosed region"


def test_truncation_boundaries(spark):
    pol = TEST_POLICY.with_(max_content_length=10)
    assert _one(spark, "<body>" + "x" * 10 + "</body>", policy=pol).content == "x" * 10
    assert _one(spark, "<body>" + "x" * 11 + "</body>", policy=pol).content == "x" * 10 + "\n\n[Content truncated]"


def test_links(spark):
    html = ('<body><a href="https://b.example.org/z">Abs</a><a href="//c.example.com/y">Sch</a>'
            '<a href="/x">  Root <b>bold</b> </a><a href="x/../y">Rel</a><a href="?q">Q</a>'
            '<a href="#f">F</a><a href="mailto:a@b">M</a><a name="noref">N</a>'
            f'<a href="/long">{"L" * 150}</a></body>')
    r = _one(spark, html, url="https://a.example.com/d/page#top")
    urls = [l.url for l in r.links]
    assert urls == ["https://b.example.org/z", "https://c.example.com/y", "https://a.example.com/x",
                    "https://a.example.com/d/y", "https://a.example.com/d/page?q",
                    "https://a.example.com/d/page#f", "https://a.example.com/long"]
    assert r.links[2].text == "Rootbold"
    assert len(r.links[-1].text) == 100


def test_link_cap_and_kind(spark):
    many = "".join(f'<a href="/p{i}">p{i}</a>' for i in range(60))
    r = _one(spark, f"<body><div>{many}</div></body>", tags=("script", "style"))
    assert len(r.links) == 50
    pol = CrawlPolicy(allowed_domains=(".example.com",), excluded_extensions=(".pdf",))
    df = spark.createDataFrame([("https://a.example.com/", "<body>" + "".join(
        f'<a href="/s{i}">s</a>' for i in range(25)) + '<a href="/x.pdf">pdf</a></body>')],
        "url string, html string")
    k = page_kind(extract_pages(df, pol), pol).collect()[0]
    assert k.kind == "thin_toc" and k.link_count == 25 and len(k.follow_these_links) == 20
    edge = spark.createDataFrame([("https://a.example.com/", "<body>" + "y" * n + "</body>") for n in (199, 200)],
                                 "url string, html string")
    kinds = [r.kind for r in page_kind(extract_pages(edge, pol), pol).orderBy(F.length("content")).collect()]
    assert kinds == ["thin_empty", "ok"]


def test_references_match_parser_rules(spark):
    from corpusflow.functions.text import decode_entities
    cases = ["a &#39;b&#39; c", "&#x27;&#X41;&#65", "&#150;&#128;&#129;&#233;", "x&#128512;y",
             "&#1114112; z", "no refs", "&amp;#39;", "&#99999999999999999999;z",
             "&copy; &middot &quot;q&quot; and&amp", "&#38;lt; &amp;amp; &ampx &lt&gt",
             "&eacute;t&eacute; &Eacute;cole &nbsp;x", "&foo; &foo.bar AT&T &#39a &#x27g end;", "a & b && c"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r[0] for r in df.select(decode_entities(F.col("s"))).collect()]

    class Text(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=False)
            self.parts = []

        def handle_data(self, d):
            self.parts.append(d)

        def handle_entityref(self, name):
            self.parts.append(entity_text(name))

        def handle_charref(self, name):
            self.parts.append(charref_text(name))

    exp = []
    for c in cases:
        t = Text()
        t.feed(c + "<x>")   # text in a page always ends at a tag
        t.close()
        exp.append("".join(t.parts))
    assert got == exp


def test_nested_regions(spark):
    cases = [
        "<body><article><p>a</p><article><p>inner</p></article><p>after inner</p></article><p>out</p></body>",
        "<body><main><div><main>x</main>y</div>z</main>w</body>",
        "<body><article>open only<p>p",
        "<body>pre<article>one</article><article>two</article></body>",
    ]
    for h in cases:
        assert _one(spark, h).content == walk(h)[1], h


def _random_page(rng):
    words = ["alpha", "beta", "Gamma", "d&eacute;j&agrave;", "x &amp; y", "&lt;tag&gt;", "&#39;q&#39;",
             "caf&#233;", "a&ampb", "  spaced  ", "tab\there", "line\nbreak", "&nbsp;", "é", " nb "]

    def text():
        return " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))

    def inline(d):
        if d > 3 or rng.random() < 0.35:
            return text()
        t = rng.choice(["b", "i", "span", "a href='/x'", "em"])
        return f"<{t}>{inline(d + 1)}{text()}</{t.split()[0]}>"

    def block(d):
        r = rng.random()
        if d > 3 or r < 0.3:
            return f"<p>{inline(d)}</p>"
        if r < 0.45:
            return f'<div class="c>d">{block(d + 1)}{block(d + 1)}</div>'
        if r < 0.55:
            return f"<nav><a href='/n'>{text()}</a></nav>"
        if r < 0.62:
            return "<script>var s='<p>no</p>';</script>"
        if r < 0.7:
            return f"<!-- {text()} -->{text()}"
        if r < 0.78:
            return "<br>" + text()
        if r < 0.85:
            return f"<ul><li>{inline(d)}</li><li>{inline(d)}</li></ul>"
        return inline(d)

    head = f"<head><title>{text() if rng.random() < 0.8 else ''}</title><style>p{{}}</style></head>"
    body = "".join(block(0) for _ in range(rng.randint(1, 5)))
    r = rng.random()
    if r < 0.3:
        body = f"{block(0)}<article>{body}</article>{block(0)}"
    elif r < 0.5:
        body = f"<main>{body}</main><article>{block(0)}</article>"
    elif r < 0.6:
        body = f"<article>{block(0)}<article>{body}</article>{block(0)}</article>"
    return f"<html>{head}<body>{body}<footer>{text()}</footer></body></html>"


def test_random_pages_match_dom_walk(spark):
    import random
    rng = random.Random(7)
    pages = [_random_page(rng) for _ in range(200)]
    df = spark.createDataFrame([(i, "https://a.example.com/p", h) for i, h in enumerate(pages)],
                               "page_id long, url string, html string")
    pol = TEST_POLICY.with_(max_content_length=10 ** 9)
    got = {r.page_id: (r.title, r.content) for r in extract_pages(df, pol).select("page_id", "title", "content").collect()}
    bad = [i for i, h in enumerate(pages) if walk(h) != got[i]]
    assert not bad, pages[bad[0]]
