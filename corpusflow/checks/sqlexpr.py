"""DuckDB SQL text for the correctness oracle.

Scalar helpers return DuckDB expressions; ``extraction`` returns a list of
CTEs that parse pages in stages, one column or one row per step, so that no
expression is spelled out inside another. The SQL is written from the parsing
rules, with patterns and reference tables of its own; it imports nothing from
the Spark column functions it checks.
"""

from __future__ import annotations

from ..config import MAX_LINK_TEXT, MAX_LINKS_PER_PAGE, TRUNCATION_MARKER

# Characters Python's str.strip() removes, as code points.
SPACE_CODES = (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# Code points at which str.splitlines() breaks.
LINE_CODES = (*range(10, 14), *range(28, 31), 0x85, 0x2028, 0x2029)
PY_SPACE = "".join(f"\\x{{{c:x}}}" for c in SPACE_CODES)
PY_LINE_BREAK = "\\r\\n|[" + "".join(f"\\x{{{c:x}}}" for c in LINE_CODES) + "]"
# What may stand between a tag's name and its closing bracket.
INSIDE = """([^>"']|"[^"]*"|'[^']*')*"""
# One character reference: number or name, then perhaps a semicolon.
REFERENCE = r"&(#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9.-]*)(;?)"
VALUE = r"""\s*=\s*("([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def lit(s: str) -> str:
    """SQL string literal; line feeds and private-use code points as chr()."""
    parts, plain = [], ""
    for ch in s:
        if ch in "\n":
            parts += ["'" + plain.replace("'", "''") + "'"] if plain else []
            parts.append(f"chr({ord(ch)})")
            plain = ""
        else:
            plain += ch
    if plain or not parts:
        parts.append("'" + plain.replace("'", "''") + "'")
    return parts[0] if len(parts) == 1 else "(" + " || ".join(parts) + ")"


def rx_replace(x: str, pat: str, rep: str) -> str:
    return f"regexp_replace({x}, {lit(pat)}, {lit(rep)}, 'g')"


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


SPACES = "(" + " || ".join(f"chr({c})" for c in SPACE_CODES) + ")"


def netloc(u: str) -> str:
    return f"lower(regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1))"


def raw_path(u: str) -> str:
    return f"regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def url_path(u: str) -> str:
    return f"lower(regexp_replace({raw_path(u)}, ';[^/]*$', ''))"


def any_of(exprs: list[str]) -> str:
    return "(" + " OR ".join(exprs) + ")" if exprs else "false"


def _any_suffix(x: str, suffixes) -> str:
    return f"list_bool_or(list_transform([{', '.join(map(lit, suffixes))}], lambda e: ends_with({x}, e)))"


def is_excluded_domain(u: str, policy) -> str:
    if not policy.excluded_domains:
        return "false"
    return (f"list_bool_or(list_transform([{', '.join(map(lit, policy.excluded_domains))}], "
            f"lambda d: contains({netloc(u)}, d)))")


def is_allowed_domain(u: str, policy) -> str:
    return _any_suffix(netloc(u), policy.allowed_domains) if policy.allowed_domains else "true"


def has_excluded_extension(u: str, policy) -> str:
    return _any_suffix(url_path(u), policy.excluded_extensions) if policy.excluded_extensions else "false"


def https_upgrade(u: str) -> str:
    return f"CASE WHEN starts_with({u}, 'http://') THEN 'https://' || substr({u}, 8) ELSE {u} END"


def element(name: str) -> str:
    return rf"<{name}(\s{INSIDE})?>"


#: Element types of the parser (fixed values): without content; content is text.
EMPTY = ("area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta "
         "nextid param source spacer track wbr").split()
TEXT_ONLY = ("script", "style")


def without_boilerplate(h: str, tags) -> str:
    """CTEs ending in ``x_doc(page_id, url, fetch_url, doc)``: the page's tokens
    are reduced one after another with the list ``st`` of open elements; ``d``
    is the place of a dropped element in it (0: none), ``o`` the text so far."""
    last = """([^>"'/]|"[^"]*"|'[^']*')"""
    raw = "|".join(rf"<{t}(\s*|\s{INSIDE}{last})>(?:.*?)(</{t}\s*>|\z)" for t in TEXT_ONLY)
    token = rf"(?is)(<!--.*?-->|{raw}|<(/?[a-zA-Z]{INSIDE}|![^>]*|\?[^>]*)>)"
    gone = f"[{', '.join(map(lit, tags))}]"
    shut = r"""(regexp_matches(tok, '/>$') AND NOT regexp_matches(tok, '=[^\s"''>]*/>$'))"""
    at = "(len(s.st) - list_position(list_reverse(s.st), e.name) + 1)"
    implied = (f"array_to_string(list_transform(list_filter(list_reverse(s.st[({at} + 1):(CASE WHEN s.d = 0 THEN len(s.st) ELSE s.d - 1 END)]), "
               f"lambda n: n IN ('main', 'article', 'body')), lambda n: '</' || n || '>'), '')")
    return rf"""x_cut AS (SELECT page_id, url, {https_upgrade('url')} AS fetch_url, regexp_extract_all(h, {lit(token)}, 1) AS toks,
    regexp_split_to_array(h, {lit(token)}) AS txts FROM (SELECT *, {h} AS h FROM pages o)),
x_tok AS (SELECT page_id, i, toks[i] AS tok, txts[i + 1] AS nxt, lower(regexp_extract(toks[i], '^</?([a-zA-Z][^\s/>]*)', 1)) AS name
          FROM (SELECT *, unnest(range(1, len(toks) + 1)) AS i FROM x_cut)),
x_kind AS (SELECT *, CASE WHEN starts_with(tok, '<!--') THEN 'alone' WHEN name = '' THEN 'none' WHEN starts_with(tok, '</') THEN 'end'
             WHEN {shut} OR name IN ({', '.join(map(lit, TEXT_ONLY))}) THEN CASE WHEN list_contains({gone}, name) THEN 'alone'
               WHEN name IN ('main', 'article', 'body') THEN 'empty' ELSE 'none' END
             WHEN name IN ({', '.join(map(lit, EMPTY))}) THEN 'none' ELSE 'begin' END AS kind FROM x_tok),
x_list AS (SELECT page_id, list({{'tok': tok, 'nxt': nxt, 'name': name, 'kind': kind}} ORDER BY i) AS es FROM x_kind GROUP BY page_id),
x_doc AS (SELECT page_id, url, fetch_url, coalesce(list_reduce(list_transform(es, lambda e: {{'st': []::VARCHAR[], 'd': 0::BIGINT, 'o': '', 'e': e}}),
   lambda s, x: CASE
     WHEN x.e.kind = 'begin' THEN {{'st': list_append(s.st, x.e.name),
       'd': CASE WHEN s.d = 0 AND list_contains({gone}, x.e.name) THEN len(s.st) + 1 ELSE s.d END,
       'o': CASE WHEN s.d > 0 THEN s.o WHEN list_contains({gone}, x.e.name) THEN s.o || chr(10) ELSE s.o || x.e.tok || x.e.nxt END, 'e': x.e}}
     WHEN x.e.kind = 'end' AND list_contains(s.st, x.e.name) THEN {{'st': s.st[1:({at.replace('e.name', 'x.e.name')} - 1)],
       'd': CASE WHEN s.d > 0 AND {at.replace('e.name', 'x.e.name')} > s.d THEN s.d ELSE 0 END,
       'o': CASE WHEN s.d > 0 AND {at.replace('e.name', 'x.e.name')} > s.d THEN s.o
                 WHEN s.d > 0 AND {at.replace('e.name', 'x.e.name')} = s.d THEN s.o || x.e.nxt
                 ELSE s.o || {implied.replace('e.name', 'x.e.name')} || x.e.tok || x.e.nxt END, 'e': x.e}}
     WHEN x.e.kind = 'alone' THEN {{'st': s.st, 'd': s.d, 'o': CASE WHEN s.d = 0 THEN s.o || chr(10) || x.e.nxt ELSE s.o END, 'e': x.e}}
     WHEN x.e.kind = 'empty' THEN {{'st': s.st, 'd': s.d,
       'o': CASE WHEN s.d = 0 THEN s.o || '<' || x.e.name || '></' || x.e.name || '>' || x.e.nxt ELSE s.o END, 'e': x.e}}
     ELSE {{'st': s.st, 'd': s.d, 'o': CASE WHEN s.d = 0 THEN s.o || x.e.tok || x.e.nxt ELSE s.o END, 'e': x.e}} END,
   {{'st': []::VARCHAR[], 'd': 0::BIGINT, 'o': txts[1], 'e': NULL}}).o, txts[1]) AS doc
  FROM x_cut LEFT JOIN x_list USING (page_id))"""


def references() -> str:
    """CTE ``refs(name, txt)``: every HTML5 reference name, from the standard
    library's table; of two spellings the one without a semicolon counts."""
    from html.entities import html5
    names: dict[str, str] = {}
    for name in sorted(html5):
        names.setdefault(name.rstrip(";"), html5[name])
    rows = chr(30).join(f"{k}{chr(31)}{v}" for k, v in names.items())
    return (f"refs AS MATERIALIZED (SELECT split_part(e, chr(31), 1) AS name, split_part(e, chr(31), 2) AS txt "
            f"FROM (SELECT unnest(string_split({lit(rows)}, chr(30))) AS e))")


def number_reference() -> str:
    """Text of a numeric reference whose value is ``code`` (null: too large)."""
    low = [chr(n) if n in (129, 141, 143, 144, 157) else bytes([n]).decode("cp1252") for n in range(128, 160)]
    return (f"CASE WHEN code IS NULL OR code > 1114111 OR code BETWEEN 55296 AND 57343 THEN chr(65533) "
            f"WHEN code BETWEEN 128 AND 159 THEN [{', '.join(map(lit, low))}][CAST(code - 127 AS INTEGER)] "
            f"ELSE chr(CAST(code AS INTEGER)) END")


def _region(name: str) -> str:
    """Inner markup of the first element ``name`` of ``doc``: the pieces
    between its tags up to the one that brings the depth back to zero."""
    tag = rf"(?is)({element(name)}|</{name}\s*>)"
    rest = f"regexp_extract(doc, {lit(rf'(?is){element(name)}(.*)' + chr(92) + 'z')}, 3)"
    parts = f"string_split(regexp_replace({rest}, {lit(tag)}, {lit(chr(2) + chr(92) + '1')}, 'g'), chr(2))"
    turn = (f"CASE WHEN regexp_matches(p, {lit(rf'(?is)^{element(name)}')}) THEN 1 "
            f"WHEN regexp_matches(p, {lit(rf'(?is)^</{name}' + chr(92) + 's*>')}) THEN -1 ELSE 0 END")
    return (f"list_reduce({parts}, lambda s, p: CASE WHEN s.d = 0 THEN s WHEN s.d + {turn} = 0 THEN {{'d': 0, 'acc': s.acc}} "
            f"ELSE {{'d': s.d + {turn}, 'acc': s.acc || p}} END, {{'d': 1, 'acc': ''}}).acc")


def truncate(text: str, n: int) -> str:
    return (f"CASE WHEN length({text}) > {n} THEN substring({text}, 1, {n}) || "
            f"{lit(TRUNCATION_MARKER)} ELSE {text} END")


def _walk(segs: str) -> str:
    """Path from segments: '..' drops the one before, '.' is skipped, a path
    under a host begins with a slash."""
    kept = (f"list_reduce({segs}, lambda acc, s: CASE WHEN s = '..' THEN acc[1:len(acc)-1] "
            f"WHEN s = '.' THEN acc ELSE list_append(acc, s) END, []::VARCHAR[])")
    joined = (f"array_to_string(CASE WHEN {segs}[-1] IN ('.', '..') THEN list_append({kept}, '') ELSE {kept} END, '/')")
    return f"regexp_replace({joined}, '^/?', '/')"


ODD_MARKUP = """CASE page_id % 7
  WHEN 1 THEN replace(html, '<article>', '<aside>before<aside>inner</aside>after</aside><article>')
  WHEN 2 THEN replace(html, '<article>', '<div><nav>menu <b>bold</div><article>')
  WHEN 3 THEN replace(html, '</article>', '')
  WHEN 4 THEN replace(html, '<article>', '<nav/><header class="x"><nav>deep</header><article><noscript>off</article>')
  WHEN 5 THEN replace(html, '</article>', '<footer>never closed</article>')
  WHEN 6 THEN html || '<script>var a = "<p>"; track('
  ELSE html END"""

VARIED = """CASE page_id % 5
  WHEN 1 THEN replace(html, '<head>', '<head><meta content=" Notes &amp; pages &#233; ' || page_id || ' " name="description">')
  WHEN 2 THEN replace(replace(html, '<article>', '<main><article>'), '</article>', '</article></main>')
  WHEN 3 THEN replace(replace(html, '<article>', '<div>'), '</article>', '</div>')
  WHEN 4 THEN replace(html, '</article>', array_to_string(list_transform(range(1, 61), lambda k: '<a href="../x' || k
              || '/./y?q=' || page_id || '&amp;r#"><b>Link</b> ' || k || '</a>'), '') || '</article>')
  ELSE html END""".replace("html", f"({ODD_MARKUP})")


def extraction(policy, tags=None, cap: int = MAX_LINKS_PER_PAGE, html: str = VARIED) -> str:
    """CTEs ending in ``px(page_id, url, fetch_url, doc, region, text, title,
    meta_description, content, links)``, one row per page."""
    tags = policy.boilerplate_tags if tags is None else tags
    tag = rf"<(/?[a-zA-Z]{INSIDE}|![^>]*|\?[^>]*)>"
    described = r"""(?s)\s(?i:name)\s*=\s*("description"|'description'|description[\s/>])"""
    anchor = rf"(?is){element('a')}.*?(</a\s*>|\z)"
    href = rf"""(?is)^<a(\s([^>"']|"[^"]*"|'[^']*')*?)?\shref{VALUE}"""

    def value(tag_col: str, pat: str, first: int) -> str:
        return " || ".join(f"regexp_extract({tag_col}, {lit(pat)}, {first + i})" for i in range(3))

    return f"""{references()},
{without_boilerplate(html, tags)},
x_reg AS (SELECT *, CASE WHEN regexp_matches(doc, {lit('(?i)' + element('main'))}) THEN {_region('main')}
                         WHEN regexp_matches(doc, {lit('(?i)' + element('article'))}) THEN {_region('article')}
                         WHEN regexp_matches(doc, {lit('(?i)' + element('body'))}) THEN {_region('body')}
                         ELSE doc END AS region FROM x_doc),
x_head AS (SELECT page_id, regexp_extract(doc, {lit(rf'(?is){element("title")}(.*?)</title' + chr(92) + 's*>')}, 3) AS title,
             list_filter(regexp_extract_all(doc, {lit(rf'(?is)<meta' + chr(92) + rf's{INSIDE}>')}, 0),
                         lambda m: regexp_matches(m, {lit(described)}))[1] AS meta FROM x_doc),
x_a AS (SELECT page_id, unnest(l) AS a, generate_subscripts(l, 1) AS pos FROM (
          SELECT page_id, list_filter(regexp_extract_all(doc, {lit(anchor)}, 0),
                                      lambda a: regexp_matches(a, {lit(rf'(?is)^<a' + chr(92) + rf's({INSIDE}' + chr(92) + 's)?href' + chr(92) + 's*=')})) AS l
          FROM x_doc)),
x_raw AS (
  SELECT page_id, 'text' AS kind, 0 AS pos, {rx_replace('region', tag, chr(10))} AS s FROM x_reg
  UNION ALL SELECT page_id, 'title', 0, CASE WHEN regexp_matches(title, '<[a-zA-Z/!?]') THEN '' ELSE title END FROM x_head
  UNION ALL SELECT page_id, 'meta', 0, {value('meta', r'(?s)\s(?i:content)' + VALUE, 2)} FROM x_head
  UNION ALL SELECT page_id, 'href', pos, {value('a', href, 4)} FROM x_a
  UNION ALL SELECT page_id, 'anchor', pos, {rx_replace(rx_replace('a', rf'(?is)^{element("a")}|</a' + chr(92) + 's*>$', ''), tag, chr(0xE000))} FROM x_a),
x_split AS (SELECT page_id, kind, pos, regexp_split_to_array(s, {lit(REFERENCE)}) AS ps,
                   regexp_extract_all(s, {lit(REFERENCE)}, 1) AS r1, regexp_extract_all(s, {lit(REFERENCE)}, 2) AS r2
            FROM x_raw WHERE s IS NOT NULL),
x_piece AS (SELECT page_id, kind, pos, i, ps[i] AS piece, r1[i] AS body, r2[i] AS sc, ps[i + 1] AS nxt
            FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM x_split)),
x_num AS (SELECT *, CASE WHEN starts_with(lower(body), '#x') THEN CAST(TRY_CAST('0x' || substr(body, 3) AS UBIGINT) AS HUGEINT)
                         WHEN starts_with(body, '#') AND length(body) <= 19 THEN TRY_CAST(substr(body, 2) AS HUGEINT) END AS code
          FROM x_piece),
x_ref AS (SELECT n.page_id, n.kind, n.pos, n.i, n.piece ||
            CASE WHEN body IS NULL THEN ''
                 WHEN NOT starts_with(body, '#') THEN coalesce(refs.txt, '&' || body)
                 WHEN sc = '' AND regexp_matches(coalesce(nxt, ''), '^[0-9a-fA-F]') THEN '&' || body
                 ELSE {number_reference()} END AS t
          FROM x_num n LEFT JOIN refs ON refs.name = n.body),
x_dec AS (SELECT page_id, kind, pos, string_agg(t, '' ORDER BY i) AS s FROM x_ref GROUP BY ALL),
x_one AS (SELECT page_id, max(s) FILTER (kind = 'title') AS title, max(s) FILTER (kind = 'meta') AS meta,
                 max(s) FILTER (kind = 'text') AS body FROM x_dec GROUP BY page_id),
x_l1 AS (SELECT d.page_id, d.pos, p.fetch_url AS b, d.s AS h0,
                CASE WHEN regexp_matches(d.s, '^//([/?#]|$)') THEN substr(d.s, 3) ELSE d.s END AS h,
                lower(regexp_extract(p.fetch_url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)) AS scheme,
                regexp_extract(p.fetch_url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS origin,
                {raw_path('p.fetch_url')} AS path
         FROM x_dec d JOIN x_doc p USING (page_id) WHERE d.kind = 'href'),
x_l2 AS (SELECT *, regexp_extract(h, '^([^?#]*)', 1) AS hp, regexp_extract(h, '^[^?#]*(.*)$', 1) AS tail,
                string_split(CASE WHEN path = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END
                             || regexp_extract(h, '^([^?#]*)', 1), '/') AS m FROM x_l1),
x_l3 AS (SELECT *, CASE WHEN starts_with(h, '/') THEN string_split(hp, '/') WHEN len(m) < 2 THEN m
                        ELSE list_concat(list_concat(m[1:1], list_filter(m[2:len(m)-1], lambda s: s <> '')), m[-1:]) END AS segs
         FROM x_l2),
x_l4 AS (SELECT *, CASE WHEN regexp_matches(h0, '^[a-zA-Z][a-zA-Z0-9+.-]*://') THEN h0
                        WHEN regexp_matches(h0, '^//[^/?#]') THEN scheme || ':' || h0
                        WHEN h = '' OR starts_with(h, '#') THEN regexp_extract(b, '^([^#]*)', 1) || h
                        WHEN regexp_matches(h, '^[?](#|$)') THEN regexp_extract(b, '^([^#]*)', 1) || substr(h, 2)
                        WHEN starts_with(h, '?') THEN regexp_extract(b, '^([^?#]*)', 1) || h
                        ELSE origin || {_walk('segs')} || tail END AS j FROM x_l3),
x_l5 AS (SELECT page_id, pos, CASE WHEN h0 = '' THEN b
                  WHEN regexp_matches(h0, '^[a-zA-Z][a-zA-Z0-9+.-]*:') AND lower(regexp_extract(h0, '^([^:]*):', 1)) <> scheme THEN h0
                  ELSE regexp_replace(regexp_replace(j, '^([^#]*)#$', '\\1'), '^([^?#]*)[?](#|$)', '\\1\\2') END AS url FROM x_l4),
x_link AS (SELECT l.page_id, l.url, row_number() OVER (PARTITION BY l.page_id ORDER BY l.pos) AS r,
                  substring(array_to_string(list_transform(string_split(t.s, chr(57344)), lambda x: {strip('x')}), ''), 1, {MAX_LINK_TEXT}) AS txt
           FROM x_l5 l JOIN x_dec t ON t.page_id = l.page_id AND t.pos = l.pos AND t.kind = 'anchor'
           WHERE starts_with(l.url, 'http://') OR starts_with(l.url, 'https://')),
x_links AS (SELECT page_id, list({{'url': url, 'text': txt}} ORDER BY r) AS links FROM x_link WHERE r <= {cap} GROUP BY page_id),
x_text AS (SELECT page_id, {strip('title')} AS title, coalesce({strip('meta')}, '') AS meta_description,
                  array_to_string(list_filter(list_transform(regexp_split_to_array(body, {lit(PY_LINE_BREAK)}),
                                                             lambda l: {strip('l')}), lambda l: l <> ''), chr(10)) AS text
           FROM x_one),
px AS (SELECT x_reg.*, t.title, t.meta_description, t.text, {truncate('t.text', policy.max_content_length)} AS content,
              coalesce(k.links, []) AS links
       FROM x_reg JOIN x_text t USING (page_id) LEFT JOIN x_links k USING (page_id))"""


def safe_title(t: str) -> str:
    kept = rx_replace(t, rf"[^\p{{L}}\p{{N}}_{PY_SPACE}-]", "")
    return f"replace({strip(f'substring({kept}, 1, 50)')}, ' ', '_')"


def doc_key(title: str, url: str) -> str:
    return f"{safe_title(title)} || '_' || substring(md5({url}), 1, 12)"
