"""DuckDB oracle SQL for the crawl queries (``corpusflow.plans.crawl``).

The SQL is written independently with the straightforward sequential
forms (window functions over the whole session, correlated rule matching),
so it cross-checks the scalable Spark formulations.
"""

from __future__ import annotations

from ..config import TEST_POLICY, TEST_THIN_LENGTH
from . import sqlexpr as X

P = TEST_POLICY
STRIDE = 1 << 40

def _base_ctes(policy=P, html: str = X.VARIED) -> str:
    tok = X.lit(policy.agent_token)
    return f"""
{X.extraction(policy, html=html)},
pages_u AS (SELECT page_id, url, html, {X.https_upgrade('url')} AS fetch_url FROM pages),
fetch_log AS (
  SELECT fetch_url AS url, page_id,
         CAST(CASE WHEN page_id % 10 = 3 THEN 404 WHEN page_id % 10 = 4 THEN NULL ELSE 200 END AS INTEGER) AS status,
         CASE WHEN page_id % 7 = 5 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END AS content_type,
         CASE WHEN page_id % 10 = 4 THEN 'timeout' END AS error,
         html
  FROM pages_u QUALIFY row_number() OVER (PARTITION BY fetch_url ORDER BY page_id) = 1),
snap AS (SELECT f.*, px.title, px.meta_description, px.content, px.links FROM fetch_log f JOIN px USING (page_id)),
hosts AS (SELECT DISTINCT {X.netloc(X.https_upgrade('url'))} AS host FROM pages),
hs AS (SELECT host, md5(host) AS h,
              CASE substr(md5(host), 1, 1) WHEN '0' THEN 401 WHEN '1' THEN 404 WHEN '2' THEN 503 ELSE 200 END AS status
       FROM hosts),
rb AS (
  SELECT host, status, NULL::INTEGER AS entry_no, NULL::VARCHAR AS agent, NULL::INTEGER AS rule_no,
         NULL::BOOLEAN AS allow, NULL::VARCHAR AS path_prefix FROM hs WHERE status <> 200
  UNION ALL SELECT host, status, 0, '*', 0, false, '/fr' FROM hs WHERE status = 200
  UNION ALL SELECT host, status, 1, {tok}, 0, true, '/fr/1' FROM hs WHERE status = 200 AND substr(h, 2, 1) < '8'
  UNION ALL SELECT host, status, 1, {tok}, 1, false, '/fr' FROM hs WHERE status = 200 AND substr(h, 2, 1) < '8'
  UNION ALL SELECT host, status, 1, {tok}, 2, false, '' FROM hs WHERE status = 200 AND substr(h, 2, 1) < '8'
  UNION ALL SELECT host, status, 1, 'otherbot', 0, false, '/' FROM hs
            WHERE status = 200 AND substr(h, 2, 1) >= '8' AND substr(h, 2, 1) < 'c'),
ent AS (
  SELECT host, max(status) AS robots_status,
         coalesce(min(entry_no) FILTER (WHERE lower(agent) <> '*' AND contains({tok}, lower(agent))),
                  min(entry_no) FILTER (WHERE agent = '*')) AS entry_no
  FROM rb GROUP BY host)"""


def _robots(src: str, key: str) -> str:
    """Rows of ``src`` (with ``fetch_url`` and key) plus ``robots_ok``."""
    pq = "regexp_extract(fetch_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(.*)$', 1)"
    return f"""(
  WITH r0 AS (SELECT s.*, e.robots_status, e.entry_no AS _entry, e.host AS _host,
                     CASE WHEN {pq} = '' THEN '/' ELSE {pq} END AS _pq
              FROM {src} s LEFT JOIN ent e ON e.host = {X.netloc('s.fetch_url')}),
       m AS (SELECT r0.{key} AS _k, arg_min(rb.allow OR rb.path_prefix = '', rb.rule_no) AS _allow
             FROM r0 JOIN rb ON rb.host = r0._host AND rb.entry_no = r0._entry
             WHERE starts_with(r0._pq, rb.path_prefix) OR rb.path_prefix = '*'
             GROUP BY r0.{key})
  SELECT r0.* EXCLUDE (robots_status, _entry, _host, _pq),
         CASE WHEN robots_status IS NULL THEN true
              WHEN robots_status IN (401, 403) THEN false
              WHEN robots_status >= 400 AND robots_status < 500 THEN true
              WHEN robots_status >= 500 THEN false
              WHEN _entry IS NULL THEN true
              ELSE coalesce(m._allow, true) END AS robots_ok
  FROM r0 LEFT JOIN m ON m._k = r0.{key})"""


def _rule(u: str, policy=P) -> str:
    return (f"CASE WHEN {X.is_excluded_domain(u, policy)} THEN 'excluded' "
            f"WHEN NOT {X.is_allowed_domain(u, policy)} THEN 'domain' "
            f"WHEN {X.has_excluded_extension(u, policy)} THEN 'extension' END")


def _kind(policy=P, n=None) -> str:
    n = policy.min_content_length if n is None else n
    follow = (f"list_filter(links, lambda l: {X.is_allowed_domain('l.url', policy)} "
              f"AND NOT {X.has_excluded_extension('l.url', policy)})")
    return (f"CASE WHEN length(content) < {n} AND len({follow}) > 0 THEN 'thin_toc' "
            f"WHEN length(content) < {n} THEN 'thin_empty' ELSE 'ok' END")


def session_sql(max_pages: int | None = None, policy=P) -> str:
    """WITH ... ending in relation ``sess`` (one row per seed row)."""
    return f"""WITH {_base_ctes(policy)},
seeds AS (SELECT page_id AS ordinal, url FROM pages
          UNION ALL SELECT page_id + {STRIDE}, url FROM pages),
{_session_ctes(max_pages, policy)}"""


def _session_ctes(max_pages: int | str | None, policy=P) -> str:
    """CTEs from ``seeds`` to ``sess``; further columns of the seeds stay."""
    over = "false" if max_pages is None else f"visits_before >= {max_pages}"
    return f"""s0 AS (SELECT *, {_rule('url', policy)} AS rule, {X.https_upgrade('url')} AS fetch_url FROM seeds),
s1 AS {_robots('s0', 'ordinal')},
s2 AS (SELECT s1.*, snap.page_id, snap.status, snap.content_type, snap.error, snap.title,
              snap.meta_description, snap.content, snap.links,
              CASE WHEN snap.url IS NULL THEN 'not_captured'
                   WHEN snap.error = 'timeout' THEN 'timeout'
                   WHEN snap.error IS NOT NULL THEN 'error'
                   WHEN snap.status >= 400 THEN 'http_error'
                   WHEN NOT contains(coalesce(snap.content_type, ''), 'text/html') THEN 'not_html'
                   ELSE 'fetched' END AS outcome
       FROM s1 LEFT JOIN snap ON snap.url = s1.fetch_url),
s3 AS (SELECT *, (rule IS NULL AND robots_ok AND outcome = 'fetched') AS ok FROM s2),
s4 AS (SELECT *, coalesce(sum(ok::INTEGER) OVER (PARTITION BY fetch_url ORDER BY ordinal
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _prev FROM s3),
s5 AS (SELECT *, _prev > 0 AS prev_ok, (ok AND _prev = 0) AS new_visit FROM s4),
s6 AS (SELECT *, CAST(coalesce(sum(new_visit::INTEGER) OVER (ORDER BY ordinal
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS visits_before FROM s5),
sess AS (SELECT *,
   CASE WHEN {over} THEN 'budget'
        WHEN prev_ok AND url = fetch_url THEN 'visited'
        WHEN rule IS NOT NULL THEN rule
        WHEN NOT robots_ok THEN 'robots'
        WHEN outcome <> 'fetched' THEN outcome
        ELSE 'ok' END AS verdict,
   visits_before + new_visit::BIGINT AS pages_crawled_so_far,
   {_kind(policy)} AS kind
   FROM s6)"""


#: Pages that lead to others, as short tables of contents.
LINKED = """coalesce(CASE WHEN page_id % 3 <> 2 THEN (
  SELECT '<html><head><title>Contents</title></head><body><h1>Contents</h1><ul>' || string_agg('<li><a href="' ||
         replace(t.url, '&', '&amp;') || '">part ' || t.page_id || '</a></li>', '' ORDER BY
         CASE t.page_id WHEN o.page_id * 2 + 1 THEN 0 WHEN o.page_id * 2 + 2 THEN 1 ELSE 2 END) || '</ul></body></html>'
  FROM pages t WHERE (t.page_id IN (o.page_id * 2 + 1, o.page_id * 2 + 2) AND t.page_id % 7 <> 0)
    OR (o.page_id % 5 = 0 AND o.page_id > 0 AND t.page_id = (o.page_id - 1) // 2)) END, html)"""


def follow_sql(depth: int, policy=P) -> str:
    """The crawl replayed level by level: the session over all rows so far,
    then the links of its last level's thin pages."""
    out = [f"""WITH {_base_ctes(policy, LINKED)},
led AS (SELECT DISTINCT t.page_id FROM pages o JOIN pages t ON o.page_id % 3 <> 2 AND (
    (t.page_id IN (o.page_id * 2 + 1, o.page_id * 2 + 2) AND t.page_id % 7 <> 0)
    OR (o.page_id % 5 = 0 AND o.page_id > 0 AND t.page_id = (o.page_id - 1) // 2))),
r0 AS (SELECT page_id AS ordinal, url, 0 AS depth FROM pages WHERE page_id NOT IN (SELECT page_id FROM led))"""]
    thin = f"{X.is_allowed_domain('l.url', policy)} AND NOT {X.has_excluded_extension('l.url', policy)}"
    for k in range(depth + 1):
        rows = " UNION ALL ".join(f"SELECT * FROM r{i}" for i in range(k + 1))
        out.append(f"""z{k} AS (WITH seeds AS ({rows}), {_session_ctes('(SELECT count(*) // 2 FROM pages)', policy)}
  SELECT * FROM sess)""")
        if k < depth:
            out.append(f"""l{k} AS (SELECT s.ordinal, i AS pos, s.links[i] AS l FROM z{k} s, generate_series(1, 50) AS g(i)
  WHERE s.depth = {k} AND s.verdict = 'ok' AND s.kind = 'thin_toc' AND i <= len(s.links)),
f{k} AS (SELECT l{k}.*, row_number() OVER (PARTITION BY ordinal ORDER BY pos) AS rank FROM l{k} WHERE {thin}
  AND NOT EXISTS (SELECT 1 FROM z{k} v WHERE v.new_visit AND v.verdict = 'ok' AND v.fetch_url = l{k}.l.url AND v.ordinal <= l{k}.ordinal)),
r{k + 1} AS (SELECT (SELECT max(ordinal) FROM r{k}) + row_number() OVER (ORDER BY ordinal, rank) AS ordinal, l.url AS url,
  {k + 1} AS depth FROM f{k} WHERE rank <= 20)""")
    follow = (f"list_filter(links, lambda l: {X.is_allowed_domain('l.url', policy)} "
              f"AND NOT {X.has_excluded_extension('l.url', policy)})")
    return (",\n".join(out) + f""" SELECT CAST(depth AS INTEGER) AS depth, url, fetch_url, verdict, new_visit AND verdict = 'ok' AS visited,
  CASE WHEN verdict = 'ok' THEN kind END AS kind,
  CASE WHEN verdict = 'ok' AND kind = 'thin_toc' THEN CAST(len({follow}) AS INTEGER) END AS link_count FROM z{depth}""")


def _detail() -> str:
    host = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)"
    return f"""CASE verdict
  WHEN 'budget' THEN 'Maximum page limit reached ({P.max_pages}). Stop crawling.'
  WHEN 'visited' THEN 'URL already visited'
  WHEN 'excluded' THEN 'Domain is in exclusion list'
  WHEN 'domain' THEN 'Domain ''' || {host} || ''' is not in the allowed domains list.'
  WHEN 'extension' THEN 'URL points to an excluded file type.'
  WHEN 'robots' THEN 'Blocked by robots.txt'
  WHEN 'timeout' THEN 'Request timed out'
  WHEN 'http_error' THEN 'HTTP error: ' || status
  WHEN 'not_html' THEN 'Not an HTML page (content-type: ' || coalesce(content_type, '') || ')'
  WHEN 'not_captured' THEN 'Page not in the captured snapshot'
  WHEN 'error' THEN error
  ELSE '' END"""


def queries() -> dict[str, str]:
    sess = session_sql()
    sess_b = session_sql(P.max_pages)
    nav_kept = tuple(t for t in P.boilerplate_tags if t != "nav")
    prompt_urls = (f"list_filter(list_transform(regexp_split_to_array(replace(coalesce(prompt, ''), ',', chr(10)), "
                   f"{X.lit(X.PY_LINE_BREAK)}), lambda u: {X.strip('u')}), lambda u: starts_with(u, 'http'))")
    q = {}
    q["seed_urls"] = f"""
WITH payloads AS (
  SELECT page_id * 2 AS payload_id, to_json({{'urls': [url]}}) AS payload FROM pages
  UNION ALL
  SELECT page_id * 2 + 1, to_json({{'prompt': 'crawl, ' || url || ',' || chr(10) || '  ' || url || chr(10)}}) FROM pages),
parsed AS (
  SELECT payload_id, CAST(json_extract(payload, '$.urls') AS VARCHAR[]) AS urls,
         json_extract_string(payload, '$.prompt') AS prompt FROM payloads),
chosen AS (
  SELECT payload_id, CASE WHEN len(coalesce(urls, [])) > 0 THEN urls ELSE {prompt_urls} END AS u FROM parsed)
SELECT payload_id, CAST(i - 1 AS INTEGER) AS pos, u[i] AS url, NULL::VARCHAR AS error
FROM chosen, range(1, len(u) + 1) t(i) WHERE len(u) > 0
UNION ALL
SELECT payload_id, 0, NULL, {X.lit("Missing 'urls' list in payload. Provide a JSON array of URLs to crawl.")}
FROM chosen WHERE len(u) = 0"""
    q["page_fetch"] = f"{sess} SELECT ordinal, url, fetch_url, outcome FROM sess WHERE rule IS NULL AND robots_ok"
    q["html_only"] = (f"WITH {_base_ctes()} SELECT url, page_id FROM fetch_log "
                      f"WHERE contains(coalesce(content_type, ''), 'text/html')")
    q["fetch_outcome"] = f"{sess} SELECT ordinal, url, verdict AS outcome, {_detail()} AS detail FROM sess"
    q["excluded_domain_filter"] = f"SELECT page_id, url, {X.is_excluded_domain('url', P)} AS excluded FROM pages"
    q["allowed_domain_filter"] = f"SELECT page_id, url, {X.is_allowed_domain('url', P)} AS allowed FROM pages"
    q["extension_filter"] = f"SELECT page_id, url, {X.has_excluded_extension('url', P)} AS excluded_ext FROM pages"
    q["https_upgrade"] = f"SELECT page_id, url, {X.https_upgrade('url')} AS fetch_url FROM pages"
    q["robots_filter"] = (f"WITH {_base_ctes()}, p0 AS (SELECT page_id, url, {X.https_upgrade('url')} AS fetch_url FROM pages) "
                          f"SELECT page_id, fetch_url, robots_ok FROM {_robots('p0', 'page_id')}")
    q["url_admission"] = f"{sess} SELECT ordinal, url, verdict FROM sess"
    q["preflight_marker"] = ("SELECT page_id, url, CASE WHEN ends_with(lower(url), '.pdf') THEN 'PDF' "
                             "WHEN NOT (contains(url, '.example.com') OR contains(url, '.example.org')) "
                             "THEN 'Non-GC domain' ELSE '' END AS marker, "
                             f"coalesce({_rule('url')}, 'admit') AS rule FROM pages")
    q["store_policy"] = (f"{sess} SELECT ordinal, fetch_url, title, CAST(length(content) AS INTEGER) AS content_length "
                         f"FROM sess WHERE verdict = 'ok' AND kind = 'ok'")
    q["page_preview"] = (f"{sess} SELECT ordinal, fetch_url AS url, title, meta_description, substring(content, 1, 2000) AS content, "
                         f"CAST(length(content) AS INTEGER) AS full_content_length, CAST(len(links) AS INTEGER) AS links_found, "
                         f"to_json(links[1:5])::VARCHAR AS sample_links, pages_crawled_so_far "
                         f"FROM sess WHERE verdict = 'ok' AND kind = 'ok'")
    q["visited_dedupe"] = f"{sess} SELECT ordinal, url, prev_ok, new_visit, verdict FROM sess"
    q["page_budget"] = f"{sess_b} SELECT ordinal, url, visits_before, verdict = 'budget' AS over_budget FROM sess"
    q["crawl_status"] = (f"{sess_b} SELECT count(*) FILTER (WHERE new_visit) AS pages_visited, "
                         f"CAST({P.max_pages} AS BIGINT) AS max_pages, "
                         f"CAST({P.max_pages} - count(*) FILTER (WHERE new_visit) AS BIGINT) AS remaining_capacity, "
                         f"count(*) FILTER (WHERE verdict = 'ok' AND kind = 'ok') AS documents_stored FROM sess")
    q["run_summary"] = (f"{sess_b} SELECT count(*) AS urls_requested, "
                        f"count(*) FILTER (WHERE verdict = 'ok' AND kind = 'ok') AS documents_stored, "
                        f"count(DISTINCT fetch_url) FILTER (WHERE verdict = 'ok' AND kind = 'ok') AS distinct_documents, "
                        f"count(*) FILTER (WHERE verdict = 'ok' AND kind = 'ok') > 0 AS ingestion_triggered FROM sess")
    q["outcome_counts"] = (f"{sess} SELECT verdict, count(*) AS n, count(DISTINCT fetch_url) AS n_urls, "
                           f"count(*) FILTER (WHERE verdict = 'ok' AND kind = 'ok') AS n_stored FROM sess GROUP BY verdict")
    q["visited_urls"] = f"{sess_b} SELECT fetch_url AS url, ordinal FROM sess WHERE new_visit"
    q["stored_documents"] = (f"{sess} SELECT row_number() OVER (ORDER BY ordinal) AS store_order, ordinal, title, fetch_url AS url "
                             f"FROM sess WHERE verdict = 'ok' AND kind = 'ok'")
    q["outcome_urls"] = f"{sess} SELECT DISTINCT verdict, fetch_url AS url FROM sess"
    q["request_schedule"] = (f"{sess} SELECT ordinal, fetch_url, slot, slot * {int(P.request_delay * 1_000_000)} AS start_offset_us FROM ("
                             f"SELECT ordinal, fetch_url, row_number() OVER (ORDER BY ordinal) - 1 AS slot FROM sess WHERE verdict "
                             f"NOT IN ('budget', 'visited', 'excluded', 'domain', 'extension', 'robots'))")
    px = f"WITH {X.extraction(P)}"
    q["strip_boilerplate"] = f"{px} SELECT page_id, CAST(length(doc) AS INTEGER) AS doc_length, md5(doc) AS doc_md5 FROM px"
    q["page_title"] = f"{px} SELECT page_id, title FROM px"
    q["meta_description"] = f"{px} SELECT page_id, meta_description FROM px"
    q["main_content"] = f"{px} SELECT page_id, CAST(length(region) AS INTEGER) AS region_length, md5(region) AS region_md5 FROM px"
    q["clean_text"] = f"{px} SELECT page_id, text FROM px"
    q["truncate_content"] = f"{px} SELECT page_id, content, CAST(length(content) AS INTEGER) AS content_length FROM px"
    q["page_links"] = (f"WITH {X.extraction(P, nav_kept)} SELECT page_id, CAST(r - 1 AS INTEGER) AS pos, url AS link_url, "
                       f"txt AS link_text FROM x_link WHERE r <= {X.MAX_LINKS_PER_PAGE}")
    q["page_kind"] = (f"{px} SELECT page_id, {_kind(P, TEST_THIN_LENGTH)} AS kind, "
                      f"CAST(length(content) AS INTEGER) AS content_length FROM px")
    q["extract_pages"] = (f"{px} SELECT page_id, fetch_url, title, meta_description, content, "
                          f"CAST(len(links) AS INTEGER) AS n_links FROM px")
    return q
