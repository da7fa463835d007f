"""URL column expressions: split, admission predicates, https upgrade,
relative link resolution.

``parse_url`` is not used: it raises on URLs with spaces under ANSI mode,
drops the port from the host and keeps ``;params`` in the path, all of
which differ from the split the crawler rules are defined on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CrawlPolicy
from .text import bind

SCHEME_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
NETLOC_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"
PATH_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def _any(cols: list[Column]) -> Column:
    # A plain OR chain over literal lists keeps whole-stage codegen (higher
    # order functions would fall back to interpreted evaluation).
    return reduce(lambda a, b: a | b, cols) if cols else F.lit(False)


def netloc(url: Column) -> Column:
    """Lower-cased network location, port and user info included."""
    return F.lower(F.regexp_extract(url, NETLOC_RE, 1))


def url_path(url: Column) -> Column:
    """Lower-cased path without query, fragment and last-segment params."""
    p = F.regexp_extract(url, PATH_RE, 1)
    return F.lower(F.regexp_replace(p, r";[^/]*$", ""))


def is_excluded_domain(url: Column, policy: CrawlPolicy) -> Column:
    host = netloc(url)
    return _any([host.contains(d) for d in policy.excluded_domains])


def is_allowed_domain(url: Column, policy: CrawlPolicy) -> Column:
    if not policy.allowed_domains:
        return F.lit(True)
    host = netloc(url)
    return _any([host.endswith(d) for d in policy.allowed_domains])


def has_excluded_extension(url: Column, policy: CrawlPolicy) -> Column:
    if not policy.excluded_extensions:
        return F.lit(False)
    p = url_path(url)
    return _any([p.endswith(e) for e in policy.excluded_extensions])


def is_followable(url: Column, policy: CrawlPolicy) -> Column:
    """Allowed domain and no excluded extension, for use inside array
    lambdas: host and path are worked out once per entry."""
    allowed = (bind(netloc(url), lambda h: _any([h.endswith(d) for d in policy.allowed_domains]))
               if policy.allowed_domains else F.lit(True))
    if not policy.excluded_extensions:
        return allowed
    return allowed & ~bind(url_path(url), lambda p: _any([p.endswith(e) for e in policy.excluded_extensions]))


def https_upgrade(url: Column) -> Column:
    """``http://`` becomes ``https://``; case-sensitive like the crawler."""
    return F.when(url.startswith("http://"),
                  F.concat(F.lit("https://"), F.substring(url, 8, 1 << 30))
                  ).otherwise(url)


def preflight_marker(url: Column, gc_markers: tuple[str, ...] = (".gc.ca", ".canada.ca")) -> Column:
    """The demo's looser pre-check: PDF on the whole URL first, then a
    domain marker searched anywhere in the URL."""
    return (F.when(F.lower(url).endswith(".pdf"), F.lit("PDF"))
            .when(~_any([url.contains(m) for m in gc_markers]), F.lit("Non-GC domain"))
            .otherwise(F.lit("")))


def _remove_dot_segments(segments: Column) -> Column:
    """Python urljoin's segment walk: '..' pops, '.' is skipped; an empty path
    becomes '/', and a path under a host always starts with '/'."""
    def walk(segs):
        kept = F.aggregate(
            segs, F.array().cast("array<string>"),
            lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
            .when(s == ".", acc)
            .otherwise(F.concat(acc, F.array(s))))
        tail = F.when(F.try_element_at(segs, F.lit(-1)).isin(".", ".."), F.array(F.lit(""))).otherwise(
            F.array().cast("array<string>"))
        return F.regexp_replace(F.array_join(F.concat(kept, tail), "/"), "^/?", "/")
    return bind(segments, walk)


def _tidy(url: Column) -> Column:
    """Re-assembly rules of ``urlunparse``: an empty query drops its '?'
    and an empty fragment drops its '#'."""
    return F.regexp_replace(F.regexp_replace(url, r"^([^#]*)#$", "$1"), r"^([^?#]*)[?](#|$)", "$1$2")


def resolve_url(base: Column, href: Column) -> Column:
    """``urllib.parse.urljoin(base, href)`` for http(s) bases.

    Handles absolute, scheme-relative, root-relative, query-only,
    fragment-only and path-relative references with dot-segment removal,
    and re-assembles like ``urlunparse`` (empty '?' / '#' dropped). Every
    intermediate value is bound once.
    """
    def parts(z):
        base, href = z["base"], z["href"]
        # '//' followed by an empty host keeps the base host: resolve the rest
        h = F.when(href.rlike(r"^//([/?#]|$)"), F.substring(href, 3, 1 << 30)).otherwise(href)
        return bind(F.struct(base.alias("base"), href.alias("href"), h.alias("h")), pieces)

    def pieces(z):
        base, h = z["base"], z["h"]
        b_path = F.regexp_extract(base, PATH_RE, 1)
        h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
        return bind(F.struct(
            base.alias("base"), z["href"].alias("href"), h.alias("h"), h_path.alias("path"),
            F.lower(F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)).alias("scheme"),
            F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1).alias("origin"),
            # base directory + href path
            F.split(F.concat(F.when(b_path == "", F.lit("/")).otherwise(F.regexp_replace(b_path, r"[^/]*$", "")),
                             h_path), "/").alias("merged")), joined)

    def joined(z):
        base, href, h, m = z["base"], z["href"], z["h"], z["merged"]
        n = F.size(m)
        # empty inner segments of a relative path are dropped
        clean = F.when(n >= 2, F.concat(F.slice(m, 1, 1), F.filter(
            F.slice(m, 2, F.greatest(n - 2, F.lit(0))), lambda s: s != ""), F.slice(m, -1, 1))).otherwise(m)
        segments = F.when(h.startswith("/"), F.split(z["path"], "/")).otherwise(clean)
        no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
        out = (F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), href)
               .when(href.rlike(r"^//[^/?#]"), F.concat(z["scheme"], F.lit(":"), href))
               .when((h == "") | h.startswith("#"), F.concat(no_fragment, h))
               # a bare '?' (empty query) keeps the base query, like a fragment-only href
               .when(h.rlike(r"^\?(#|$)"), F.concat(no_fragment, F.substring(h, 2, 1 << 30)))
               .when(h.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), h))
               .otherwise(F.concat(z["origin"], _remove_dot_segments(segments),
                                   F.regexp_extract(h, r"^[^?#]*(.*)$", 1))))
        return (F.when(href == "", base)
                .when(href.rlike(SCHEME_RE) & (F.lower(F.regexp_extract(href, r"^([^:]*):", 1)) != z["scheme"]), href)
                .otherwise(_tidy(out)))
    return bind(F.struct(base.alias("base"), href.alias("href")), parts)
