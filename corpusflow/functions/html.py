"""HTML extraction as native column expressions.

A page is never handed to a Python parser: boilerplate removal, title,
meta description, main region, text lines and anchors are regular
expressions and array functions evaluated by the JVM, so extraction of a
whole ``pages`` table is one narrow projection with no shuffle.

Semantics follow a DOM walk with text nodes joined one per line:
* comments and whole boilerplate elements are replaced by a line break
  (they separate two text nodes),
* the first element present among main / article / body wins, even empty,
* every tag boundary is a line break, lines are stripped, blanks dropped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (MAX_LINK_TEXT, MAX_LINKS_PER_PAGE, DEFAULT_BOILERPLATE_TAGS)
from .text import bind, clean_lines, decode_entities, py_strip
from .urls import resolve_url

# Inside a tag: any run of characters where quoted attribute values may
# contain '>'.
_IN_TAG = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""
# A markup token: start/end tag, declaration/comment or processing instruction.
TAG_RE = rf"<(?:/?[a-zA-Z]{_IN_TAG}|![^>]*|\?[^>]*)>"
TEXT_NODE_SEP = "\ue000"   # private-use code point: separates text nodes


def open_tag(name: str) -> str:
    return rf"<{name}(?:\s{_IN_TAG})?>"


# --- Fixed values: element types of the HTML parser --------------------------
VOID_TAGS = ("area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img",
             "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track",
             "wbr")
RAW_TEXT_TAGS = ("script", "style")     # their content is not markup
# --- end of fixed values -----------------------------------------------------
REGION_TAGS = ("main", "article", "body")
PIECE = "\x01"          # between the pieces of a page
NEITHER, OPENS, CLOSES, ALONE, EMPTY = 0, 1, 2, 3, 4


def raw_element_re(name: str) -> str:
    """A raw-text element up to its end tag or the end of the page; not the
    self-closed form."""
    last = r"""(?:[^>"'/]|"[^"]*"|'[^']*')"""
    return rf"<{name}(?:\s*|\s{_IN_TAG}{last})>.*?(?:</{name}\s*>|\z)"


#: Markup tokens: comments and raw-text elements whole, else single tags.
TOKEN_RE = "(?is)" + "|".join(["<!--.*?-->", *map(raw_element_re, RAW_TEXT_TAGS), TAG_RE])


def _pieces(html: Column) -> Column:
    """Texts and markup tokens in turn; a text stands at every even place."""
    def both(tokens: Column, texts: Column) -> Column:
        return F.concat(F.slice(texts, 1, 1), F.flatten(F.transform(
            tokens, lambda t, i: F.array(t, F.get(texts, i + 1)))))
    # one pass with marks around the tokens, unless the page holds the mark
    marked = F.split(F.regexp_replace(html, TOKEN_RE, f"{PIECE}$0{PIECE}"), PIECE)
    apart = bind(F.regexp_extract_all(html, F.lit(TOKEN_RE), F.lit(0)),
                 lambda tokens: bind(F.split(html, TOKEN_RE), lambda texts: both(tokens, texts)))
    return F.when(html.contains(PIECE), apart).otherwise(marked)


def _token_marks(pieces: Column, tags) -> Column:
    """``array<struct<at, kind, name>>`` of the tokens that matter: tags that
    open or close an element, what is dropped on its own, and regions that are
    closed in their own tag."""
    def mark(t, i):
        def of(name):
            closed = t.endswith("/>") & ~t.rlike(r"""=[^\s"'>]*/>$""")
            kind = (F.when(t.startswith("<!--"), ALONE)
                    .when(name == "", NEITHER)
                    .when(t.startswith("</"), CLOSES)
                    .when(closed | name.isin(*RAW_TEXT_TAGS),
                          F.when(name.isin(*tags), ALONE).when(name.isin(*REGION_TAGS), EMPTY).otherwise(NEITHER))
                    .when(name.isin(*VOID_TAGS), NEITHER)
                    .otherwise(OPENS))
            return F.struct(i.alias("at"), kind.alias("kind"), name.alias("name"))
        return F.when(i % 2 == 1, bind(F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1)), of))
    return F.filter(F.transform(pieces, mark), lambda m: m.isNotNull() & (m["kind"] != NEITHER))


_CUT = "struct<first: int, last: int, put: string>"


def _cut(first, last, put) -> Column:
    return F.array(F.struct(first.alias("first"), last.alias("last"), put.alias("put")))


def _fold_step(s: Column, m: Column, tags) -> Column:
    """One token of the stack fold. ``open`` holds the names of the open
    elements, ``drop`` the depth of the dropped element the token is in (0:
    none), which began at place ``since``. An end tag closes the nearest open
    element of its name and all inside it, or nothing. ``at`` is the token's
    place among the pieces, the text before it is one place earlier."""
    here = m["at"]
    none = F.array().cast(f"array<{_CUT}>")

    def state(open_, drop, since, more):
        return F.struct(open_.alias("open"), drop.alias("drop"), since.alias("since"),
                        F.concat(s["cuts"], more).alias("cuts"))

    def opened() -> Column:
        begins = (s["drop"] == 0) & m["name"].isin(*tags)
        return state(F.array_append(s["open"], m["name"]),
                     F.when(begins, F.size(s["open"]) + 1).otherwise(s["drop"]),
                     F.when(begins, here).otherwise(s["since"]), none)

    def closed(p: Column) -> Column:
        ends = (s["drop"] > 0) & (p <= s["drop"])
        own = ends & (p == s["drop"])
        # elements that end without an end tag of their own; inside a dropped
        # one they do not show
        top = F.when(s["drop"] == 0, F.size(s["open"])).otherwise(s["drop"] - 1)
        implied = F.filter(F.slice(s["open"], p + 1, F.greatest(top - p, F.lit(0))), lambda n: n.isin(*REGION_TAGS))
        ends_of = F.array_join(F.transform(F.reverse(implied), lambda n: F.concat(F.lit("</"), n, F.lit(">"))), "")
        dropped = F.when(ends, _cut(s["since"], F.when(own, here).otherwise(here - 1), F.lit("\n"))).otherwise(none)
        shown = ~own & ((s["drop"] == 0) | ends) & (F.size(implied) > 0)
        return state(F.slice(s["open"], F.lit(1), p - 1), F.when(ends, 0).otherwise(s["drop"]), s["since"],
                     F.concat(dropped, F.when(shown, _cut(here, here - 1, ends_of)).otherwise(none)))

    nearest = F.size(s["open"]) + 1 - F.array_position(F.reverse(s["open"]), m["name"]).cast("int")
    put = F.when(m["kind"] == EMPTY, F.concat(F.lit("<"), m["name"], F.lit("></"), m["name"], F.lit(">"))).otherwise("\n")
    alone = F.when(s["drop"] == 0, state(s["open"], s["drop"], s["since"], _cut(here, here, put))).otherwise(s)
    return (F.when(m["kind"] == OPENS, opened())
            .when(m["kind"].isin(ALONE, EMPTY), alone)
            .when(F.array_contains(s["open"], m["name"]), bind(nearest, closed))
            .otherwise(s))


def strip_boilerplate(html: Column, tags=DEFAULT_BOILERPLATE_TAGS) -> Column:
    """Drop comments and boilerplate elements, each leaving a line break, by a
    fold over the page's tags with the stack of open elements; nested elements
    of one name and elements without an end tag end where the parser ends them.
    Regions that end without their end tag get one, so ``main_region`` can go
    by the tags of one name."""
    tags = tuple(tags)

    def rebuilt(pieces: Column) -> Column:
        start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(0).alias("drop"), F.lit(0).alias("since"),
                         F.array().cast(f"array<{_CUT}>").alias("cuts"))
        cuts = F.aggregate(
            _token_marks(pieces, tags), start, lambda s, m: _fold_step(s, m, tags),
            lambda s: F.when(s["drop"] > 0, F.concat(s["cuts"], _cut(s["since"], F.size(pieces) - 1, F.lit("\n"))))
            .otherwise(s["cuts"]))

        def joined(cs: Column) -> Column:
            def kept(c, k):
                before = F.coalesce(F.get(cs, k - 1)["last"], F.lit(-1))
                return F.concat(F.array_join(F.slice(pieces, before + 2, c["first"] - before - 1), ""), c["put"])
            last = F.coalesce(F.get(cs, F.size(cs) - 1)["last"], F.lit(-1))
            return F.concat(F.array_join(F.transform(cs, kept), ""),
                            F.array_join(F.slice(pieces, last + 2, F.greatest(F.size(pieces) - last - 1, F.lit(0))), ""))
        return bind(cuts, joined)
    return bind(_pieces(html), rebuilt)


def page_title(doc: Column) -> Column:
    """Text of the first ``<title>``; '' if absent, empty or holding markup."""
    raw = F.regexp_extract(doc, rf"(?is){open_tag('title')}(.*?)</title\s*>", 1)
    return bind(raw, lambda r: F.when(r.rlike(r"<[a-zA-Z/!?]"), F.lit("")).otherwise(py_strip(decode_entities(r))))


_ATTR_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_IN_TAG_LAZY = r"""(?:[^>"']|"[^"]*"|'[^']*')*?"""
META_TAG_RE = rf"(?is)<meta\s{_IN_TAG}>"
ANCHOR_RE = rf"(?is){open_tag('a')}.*?(?:</a\s*>|\z)"
HREF_RE = rf"(?is)^<a(?:\s{_IN_TAG_LAZY})?\shref{_ATTR_VALUE}"
HAS_HREF_RE = rf"(?is)^<a\s(?:{_IN_TAG}\s)?href\s*="
ANCHOR_TAGS_RE = rf"(?is)^{open_tag('a')}|</a\s*>$"


def _attr(tag: Column, name: str) -> Column:
    pat = rf"(?s)\s(?i:{name}){_ATTR_VALUE}"
    return F.concat(F.regexp_extract(tag, pat, 1), F.regexp_extract(tag, pat, 2),
                    F.regexp_extract(tag, pat, 3))


def meta_description(doc: Column) -> Column:
    """``content`` of the first ``<meta name="description">`` (value matched
    exactly), stripped; '' if absent."""
    metas = F.regexp_extract_all(doc, F.lit(META_TAG_RE), 0)
    name_is_desc = r"""(?s)\s(?i:name)\s*=\s*(?:"description"|'description'|description[\s/>])"""
    first = F.try_element_at(F.filter(metas, lambda m: m.rlike(name_is_desc)), F.lit(1))
    return F.coalesce(bind(first, lambda t: py_strip(decode_entities(_attr(t, "content")))), F.lit(""))


MARK = "\x02"   # marks open / close tags of the region element


def region_tags_re(name: str) -> str:
    return rf"(?is)({open_tag(name)}|</{name}\s*>)"


def _region(doc: Column, name: str) -> Column:
    """Inner markup of the first ``name`` element, with nesting: every open
    and close tag of that name after the first open tag is marked, the text
    is split at the marks and a fold over the pieces tracks the depth until
    the element's own closing tag (an unclosed element runs to the end)."""
    rest = F.regexp_extract(doc, rf"(?is){open_tag(name)}(.*)\z", 1)
    parts = F.split(F.regexp_replace(rest, region_tags_re(name), MARK + "$1"), MARK)
    start = F.struct(F.lit(1).alias("d"), F.lit(False).alias("done"), F.lit("").alias("acc"))

    def step(st, part):
        d = st["d"] + (F.when(part.rlike(rf"(?is)^{open_tag(name)}"), 1)
                       .when(part.rlike(rf"(?is)^</{name}\s*>"), -1).otherwise(0))
        return (F.when(st["done"], st)
                .when(d == 0, F.struct(F.lit(0).alias("d"), F.lit(True).alias("done"), st["acc"].alias("acc")))
                .otherwise(F.struct(d.alias("d"), F.lit(False).alias("done"), F.concat(st["acc"], part).alias("acc"))))
    nested = F.aggregate(parts, start, step)["acc"]
    # fast path: without a nested open tag the first close tag ends the
    # element, so the plain non-greedy match is already exact
    simple = F.regexp_extract(doc, rf"(?is){open_tag(name)}(.*?)(?:</{name}\s*>|\z)", 1)
    return bind(simple, lambda s_: F.when(s_.rlike(rf"(?i){open_tag(name)}"), nested).otherwise(s_))


def main_region(doc: Column) -> Column:
    """Inner markup of the first main / article / body present, else all."""
    def has(name):
        return doc.rlike(rf"(?i){open_tag(name)}")
    return (F.when(has("main"), _region(doc, "main"))
            .when(has("article"), _region(doc, "article"))
            .when(has("body"), _region(doc, "body"))
            .otherwise(doc))


def clean_text(region: Column) -> Column:
    """Text nodes one per line, stripped, blank lines dropped."""
    return clean_lines(decode_entities(F.regexp_replace(region, TAG_RE, "\n")))


def truncate_content(text: Column, max_len: int) -> Column:
    """Cut at ``max_len`` code points and append the truncation marker."""
    return bind(text, lambda t: F.when(F.length(t) > max_len,
                                       F.concat(F.substring(t, 1, max_len), F.lit("\n\n[Content truncated]"))
                                       ).otherwise(t))


def anchor_text(inner: Column) -> Column:
    """Anchor text: text nodes stripped and concatenated, first 100 chars."""
    nodes = F.split(decode_entities(F.regexp_replace(inner, TAG_RE, TEXT_NODE_SEP)), TEXT_NODE_SEP)
    return F.substring(F.array_join(F.transform(nodes, py_strip), ""), 1, MAX_LINK_TEXT)


def page_links(doc: Column, base_url: Column, cap: int = MAX_LINKS_PER_PAGE) -> Column:
    """``ARRAY<STRUCT<url, text>>`` of anchors with an href, resolved against
    the page URL, http(s) only, in document order, first ``cap`` kept."""
    anchors = F.regexp_extract_all(doc, F.lit(ANCHOR_RE), 0)
    parsed = F.transform(anchors, lambda a: F.struct(
        a.rlike(HAS_HREF_RE).alias("has_href"),
        decode_entities(F.concat(F.regexp_extract(a, HREF_RE, 1), F.regexp_extract(a, HREF_RE, 2),
                                 F.regexp_extract(a, HREF_RE, 3))).alias("href"),
        F.regexp_replace(a, ANCHOR_TAGS_RE, "").alias("inner")))
    resolved = F.transform(F.filter(parsed, lambda p: p["has_href"]), lambda p: F.struct(
        resolve_url(base_url, p["href"]).alias("url"), anchor_text(p["inner"]).alias("text")))
    http = F.filter(resolved, lambda l: l["url"].startswith("http://") | l["url"].startswith("https://"))
    return F.slice(http, 1, cap)
