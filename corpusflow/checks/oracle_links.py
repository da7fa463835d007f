"""DuckDB oracle SQL for link, spacing and streaming queries: the TOC
expansion is a recursive CTE (depth-bounded, minimum depth per URL)."""

from __future__ import annotations

from ..config import TEST_POLICY, TEST_THIN_LENGTH
from . import sqlexpr as X
from ..plans.links import FOLLOW_DEPTH
from .oracle_crawl import _base_ctes, follow_sql, session_sql

P = TEST_POLICY

LINKS = """links AS (
  SELECT s.url AS page_url, CAST(0 AS INTEGER) AS pos, t.url AS link_url
  FROM pages s JOIN pages t ON t.page_id = s.page_id * 2 + 1 AND t.page_id % 7 <> 0
  UNION ALL
  SELECT s.url, CAST(1 AS INTEGER), t.url FROM pages s JOIN pages t ON t.page_id = s.page_id * 2 + 2 AND t.page_id % 7 <> 0
  UNION ALL
  SELECT s.url, CAST(2 AS INTEGER), t.url FROM pages s JOIN pages t ON t.page_id = (s.page_id - 1) // 2
  WHERE s.page_id % 5 = 0 AND s.page_id > 0)"""


def queries() -> dict[str, str]:
    sess = session_sql()
    follow = f"{X.is_allowed_domain('link_url', P)} AND NOT {X.has_excluded_extension('link_url', P)}"
    q = {}
    q["unvisited_links"] = (f"{sess}, {LINKS} SELECT page_url, pos, link_url FROM links "
                            f"WHERE link_url NOT IN (SELECT fetch_url FROM sess WHERE new_visit)")
    q["link_limits"] = f"""{sess}, {LINKS},
dense AS (SELECT * FROM links UNION ALL
          SELECT s.url, CAST(t.page_id - s.page_id + 2 AS INTEGER), t.url FROM pages s
          JOIN pages t ON t.page_id BETWEEN s.page_id + 1 AND s.page_id + 60 WHERE s.page_id % 11 = 0),
kept AS (SELECT * FROM dense WHERE pos < 50),
cand AS (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY pos) AS r FROM kept
         WHERE link_url NOT IN (SELECT fetch_url FROM sess WHERE new_visit) AND {follow}),
k AS (SELECT page_url, count(*) AS links_found, count(*) FILTER (WHERE pos < 5) AS n_sample FROM kept GROUP BY page_url),
c AS (SELECT page_url, count(*) AS link_count, count(*) FILTER (WHERE r <= 20) AS n_follow FROM cand GROUP BY page_url)
SELECT k.page_url, links_found, n_sample, coalesce(link_count, 0) AS link_count, coalesce(n_follow, 0) AS n_follow
FROM k LEFT JOIN c ON c.page_url = k.page_url"""
    q["toc_expand"] = f"""WITH RECURSIVE {_base_ctes()}, {LINKS},
toc AS (SELECT url FROM snap WHERE error IS NULL AND status < 400
        AND contains(coalesce(content_type, ''), 'text/html') AND length(content) < {TEST_THIN_LENGTH}),
seeds AS (SELECT url FROM pages WHERE url NOT IN (SELECT link_url FROM links)),
walk(url, depth) AS (
  SELECT url, 0 FROM seeds
  UNION
  SELECT l.link_url, w.depth + 1
  FROM walk w JOIN toc ON toc.url = {X.https_upgrade('w.url')}
  JOIN links l ON l.page_url = w.url
  WHERE {follow.replace('link_url', 'l.link_url')} AND w.depth < (SELECT count(*) FROM pages))
SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY url"""
    q["crawl_follow"] = follow_sql(FOLLOW_DEPTH)
    q["request_spacing"] = f"""SELECT event_id,
  coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER w, -1) AS gap_us,
  coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER w < {int(P.request_delay * 1_000_000)}, false) AS too_close
FROM events WINDOW w AS (ORDER BY ts, event_id)"""
    q["stream_ingest"] = (f"WITH {X.extraction(P, html='html')} SELECT fetch_url, title, CAST(length(content) AS INTEGER) AS content_length "
                          f"FROM (SELECT * FROM px QUALIFY row_number() OVER (PARTITION BY fetch_url ORDER BY page_id) = 1) "
                          f"WHERE NOT ({X.is_excluded_domain('url', P)} OR NOT {X.is_allowed_domain('url', P)} "
                          f"OR {X.has_excluded_extension('url', P)})")
    return q
