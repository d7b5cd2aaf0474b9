"""The catalogue's queries as SQL for an independent check on the same tables.

Written for the shapes that occur in the tables (root-relative links, queries without
escapes) and in another way than the Spark side: regular expressions for markup,
explicit joins over the five tables for the report, a recursive query for the graph.
"""

from __future__ import annotations

_TRACKING = "'utm_source', 'utm_medium', 'utm_campaign', 'utm_content', 'utm_term'"
_START = "TIMESTAMP '2024-01-01 00:00:00'"


def _canonical(url: str) -> str:
    head = rf"lower(regexp_extract({url}, '^([A-Za-z]+://[^/?#]*)', 1))"
    path = rf"regexp_extract({url}, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)"
    query = rf"regexp_extract({url}, '^[^?#]*\?([^#]*)', 1)"
    kept = (
        f"list_sort(list_filter(string_split({query}, '&'), "
        f"lambda x: x <> '' AND lower(split_part(x, '=', 1)) NOT IN ({_TRACKING})))"
    )
    joined = f"coalesce(array_to_string({kept}, '&'), '')"
    return (
        f"({head} || {path} || CASE WHEN {path} LIKE '%/' THEN '' ELSE '/' END "
        f"|| CASE WHEN {joined} = '' THEN '' ELSE '?' || {joined} END)"
    )


def _host(url: str) -> str:
    return rf"regexp_extract({url}, '^[a-z]+://([^/?#:]*)', 1)"


def _path(url: str) -> str:
    return rf"regexp_extract({url}, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


def _internal(url: str) -> str:
    return f"(suffix({_host(url)}, 'example.com'))"


def _crawlable(url: str) -> str:
    return (
        f"({_internal(url)} AND regexp_full_match({_path(url)}, "
        r"'/(en|fr)/[0-9]+(\.html)?/|/[^/]+/'))"
    )


def _article(url: str) -> str:
    return f"({url} LIKE '%/en/%' OR {url} LIKE '%/fr/%')"


def _unescape(text: str) -> str:
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


# Pages with canonical URL and fetch time; p_text adds title and visible text.
_PAGES = f"""
p AS (
  SELECT page_id, url AS raw_url, html, {_canonical("url")} AS url,
         {_START} + to_seconds(page_id) AS fetched_at
  FROM pages
),
p_text AS (
  SELECT *,
    nullif({_unescape("regexp_extract(html, '<title>([^<]*)</title>', 1)")}, '') AS title,
    {_unescape('''array_to_string(list_filter(list_transform(
      string_split_regex(
        regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '<x>', 'g'),
        '<[^>]*(?:>|$)'),
      lambda x: trim(x, chr(9) || chr(10) || chr(13) || ' ')), lambda x: x <> ''), ' ')''')} AS text_content
  FROM p
),
stored AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY fetched_at, url) AS copy
    FROM (
      SELECT *, sha256(text_content) AS content_hash,
             row_number() OVER (PARTITION BY url ORDER BY fetched_at) AS nth
      FROM p_text
    ) WHERE nth = 1
  ) WHERE copy = 1
)"""

_ANCHOR = "'<a href=\"([^\"]*)\">([^<]*)'"


def _links(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT page_id, url, fetched_at, pos,
         regexp_extract(raw_url, '^([a-z]+://[^/?#]*)', 1) || href AS resolved,
         {_canonical("(regexp_extract(raw_url, '^([a-z]+://[^/?#]*)', 1) || href)")} AS to_url,
         trim({_unescape("anchor")}) AS anchor_text
  FROM (
    SELECT page_id, url, raw_url, fetched_at,
           unnest(range(len(regexp_extract_all(html, {_ANCHOR}))))::INTEGER AS pos,
           unnest(regexp_extract_all(html, {_ANCHOR}, 1)) AS href,
           unnest(regexp_extract_all(html, {_ANCHOR}, 2)) AS anchor
    FROM {source}
  )
)"""


# The five tables after a crawl that started from every page.
_TABLES = f"""WITH {_PAGES},
{_links("stored", "l")},
t_urls AS (
  SELECT url, {_host("url")} AS host FROM p UNION SELECT to_url, {_host("to_url")} FROM l
),
t_pages AS (
  SELECT url, title, CASE WHEN contains(html, '</html>') THEN 200 ELSE 206 END AS http_status
  FROM stored
),
t_links AS (
  SELECT url AS from_url, pos, to_url, anchor_text, {_internal("to_url")} AS is_internal,
         false AS nofollow, fetched_at AS discovered_at
  FROM l
),
t_seeds AS (SELECT url, min(fetched_at) AS seen_at FROM p GROUP BY url),
t_found AS (
  SELECT * FROM (
    SELECT to_url AS url, from_url, discovered_at AS seen_at,
           row_number() OVER (PARTITION BY to_url ORDER BY from_url) AS offer
    FROM t_links WHERE {_crawlable("to_url")} AND to_url NOT IN (SELECT url FROM t_seeds)
  ) WHERE offer = 1
),
t_frontier AS (
  SELECT url, 'done' AS status, 0 AS depth, 10 AS priority, NULL AS discovered_from, seen_at
  FROM t_seeds
  UNION ALL SELECT url, 'queued', 1, 100, from_url, seen_at FROM t_found
)
"""

_EVENTS = """
attempts AS (
  SELECT event_id, user_id::VARCHAR AS url, ts AS attempted_at, event_type <> 'error' AS success,
         CASE WHEN event_type = 'error' THEN
           CASE WHEN event_id % 2 = 0 THEN 'request timed out' ELSE 'network failure' END
         END AS error_message,
         CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 200 WHEN 'signup' THEN 301
              WHEN 'purchase' THEN 404 END AS http_status,
         trunc(value)::INTEGER AS response_time_ms
  FROM events
)"""


def _states(attempts: str) -> str:
    """Retry state per URL by running counts over all its attempts."""
    return f"""
running AS (
  SELECT *,
    coalesce(sum(CASE WHEN success THEN 1 ELSE 0 END) OVER earlier, 0) AS successes_before,
    coalesce(sum(CASE WHEN success THEN 0 ELSE 1 END) OVER earlier, 0) AS failures_before
  FROM {attempts}
  WINDOW earlier AS (PARTITION BY url ORDER BY attempted_at, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
states AS (
  SELECT url,
    CASE WHEN bool_or(success) THEN 'done'
         WHEN count(*) FILTER (NOT success) >= 3 THEN 'failed' ELSE 'queued' END AS status,
    (count(*) FILTER (NOT success))::INTEGER AS attempt_count,
    max(attempted_at + to_seconds(5 * CASE failures_before WHEN 0 THEN 1 ELSE 3 END))
      FILTER (NOT success AND failures_before < 2) AS next_fetch_at,
    max(error_message) FILTER (NOT success AND failures_before = 2) AS last_error
  FROM running WHERE successes_before = 0 AND failures_before < 3 GROUP BY url
)"""


def _top(select: str, key: str) -> str:
    return f"{select} ORDER BY cnt DESC, {key} ASC NULLS LAST LIMIT 10"


# Links of stored article pages, with the page's title and the target's host.
_ARTICLE_LINKS = f"""(
  SELECT from_url, anchor_text, is_internal,
         (SELECT any_value(title) FROM t_pages WHERE url = from_url) AS title,
         (SELECT any_value(host) FROM t_urls WHERE url = to_url) AS host
  FROM t_links
  WHERE {_article("from_url")} AND from_url IN (SELECT url FROM t_pages)
) AS article_links"""


def _counted(column: str, condition: str = "TRUE") -> str:
    return (
        f"SELECT {column}, sum(1)::BIGINT AS cnt FROM {_ARTICLE_LINKS} "
        f"WHERE {condition} GROUP BY {column}"
    )


_EXTERNAL_HOSTS = _top(_counted("host", "NOT is_internal"), "host")
_ANCHORS = _top(_counted("anchor_text", "anchor_text <> ''"), "anchor_text")
_TITLES = _top(_counted("title"), "title")
_BY_TYPE = _counted("is_internal")
_STATUSES = "SELECT status, count(*)::BIGINT AS cnt FROM t_frontier GROUP BY status"
_HTTP = "SELECT http_status, count(*)::BIGINT AS cnt FROM t_pages GROUP BY http_status"
_DEPTHS = "SELECT depth, status, count(*)::BIGINT AS cnt FROM t_frontier GROUP BY depth, status"
_HUBS = "SELECT count_if(url LIKE '%/de/%')::BIGINT AS cnt FROM t_pages"
_ARTICLES = f"SELECT count_if({_article('url')})::BIGINT AS cnt FROM t_pages"
_TOTAL = "SELECT count(*)::BIGINT AS cnt FROM t_pages"


def _ranked(section: str, query: str, key: str, order: str) -> str:
    return (
        f"SELECT '{section}' AS section, (row_number() OVER (ORDER BY {order}))::INTEGER AS rank, "
        f"{key} AS key, cnt FROM ({query})"
    )


_REPORT = " UNION ALL ".join(
    [
        f"SELECT 'pages' AS section, 1 AS rank, 'total' AS key, cnt FROM ({_TOTAL})",
        f"SELECT 'pages', 2, 'hubs', cnt FROM ({_HUBS})",
        f"SELECT 'pages', 3, 'articles', cnt FROM ({_ARTICLES})",
        _ranked(
            "links", _BY_TYPE, "CASE WHEN is_internal THEN 'internal' ELSE 'external' END",
            "is_internal DESC",
        ),
        _ranked("frontier", _STATUSES, "status", "status"),
        _ranked("external hosts", _EXTERNAL_HOSTS, "host", "cnt DESC, host ASC NULLS LAST"),
        _ranked("anchors", _ANCHORS, "anchor_text", "cnt DESC, anchor_text ASC NULLS LAST"),
        _ranked(
            "http status", _HTTP, "coalesce(nullif(http_status, 0)::VARCHAR, 'N/A')",
            "cnt DESC, http_status ASC NULLS LAST",
        ),
        _ranked(
            "depth", _DEPTHS, "'depth=' || depth || ', status=' || status", "depth, status"
        ),
        _ranked(
            "linking articles", _TITLES, "coalesce(nullif(left(title, 60), ''), 'N/A')",
            "cnt DESC, title ASC NULLS LAST",
        ),
    ]
)

# Pages as nodes, linked with the root of their site in both directions; hub pages start.
_LEVELS = f"""WITH RECURSIVE {_PAGES},
edges AS (
  SELECT DISTINCT url AS from_url, regexp_extract(url, '^([a-z]+://[^/]*/)', 1) AS to_url FROM p
  UNION
  SELECT DISTINCT regexp_extract(url, '^([a-z]+://[^/]*/)', 1), url FROM p
),
walk AS (
  SELECT DISTINCT url, 0 AS depth FROM p WHERE url LIKE '%/de/%'
  UNION
  SELECT e.to_url, w.depth + 1 FROM walk w JOIN edges e ON e.from_url = w.url WHERE w.depth < 2
),
levels AS (SELECT url, min(depth)::INTEGER AS depth FROM walk GROUP BY url)
"""

_NO_SCHEME = "regexp_replace(url, '^https?:', '')"

SQL = {
    "raw_pages": f"""
        SELECT url, CASE WHEN contains(html, '</html>') THEN 200 ELSE 206 END AS http_status,
               'text/html; charset=utf-8' AS content_type, strlen(html)::BIGINT AS content_length,
               true AS is_html, NULL::VARCHAR AS error,
               {_START} + to_seconds(page_id) AS fetched_at, sha256(html) AS body_hash
        FROM pages""",
    "seed_urls": f"WITH {_PAGES} SELECT DISTINCT url FROM p WHERE url LIKE '%/de/%'",
    "list_seeds": f"""WITH seeds AS (
        SELECT DISTINCT 'https://example.com/ru/hubs/machine_learning/articles/page' || i || '/' AS url
        FROM range(21, 100) t(i)),
      held AS (SELECT DISTINCT {_canonical('url')} AS url FROM pages)
      SELECT s.url, h.url IS NOT NULL AS held FROM seeds s LEFT JOIN held h ON s.url = h.url""",
    "normalize_url": f"SELECT page_id, url, {_canonical('url')} AS canonical FROM pages",
    "url_parts": rf"""WITH {_PAGES}
        SELECT page_id, regexp_extract(url, '^([a-z]+):', 1) AS scheme, {_host("url")} AS host,
               {_path("url")} AS path, regexp_extract(url, '\?(.*)$', 1) AS query FROM p""",
    "url_internal": f"WITH {_PAGES} SELECT page_id, {_internal('url')} AS is_internal FROM p",
    "crawlable_urls": f"WITH {_PAGES} SELECT page_id, {_crawlable('url')} AS crawlable FROM p",
    "robots_allowed": f"""SELECT page_id, {_internal("url")} AND NOT starts_with({_path("url")}, '/es/')
        AS allowed FROM pages""",
    "page_kind": f"""WITH {_PAGES} SELECT page_id, {_article("url")} AS is_article,
        url LIKE '%/de/%' AS is_hub FROM p""",
    # Only the first of the five forms may be stored. None has a dot segment or a port.
    "invalid_urls": rf"""
        WITH forms AS (
          SELECT page_id, 1 AS form, {_NO_SCHEME} AS raw, 'unsupported scheme' AS reason FROM pages
          UNION ALL SELECT page_id, 2, regexp_replace({_NO_SCHEME}, '^//[^/]*', ''),
                           'unsupported scheme' FROM pages
          UNION ALL SELECT page_id, 3, 'xmpp:bot@' || {_host("url")}, 'unsupported scheme' FROM pages
          UNION ALL SELECT page_id, 4, 'http://' || regexp_replace({_NO_SCHEME}, '^//[^/]*', ''),
                           'no host' FROM pages
        )
        SELECT page_id, form::INTEGER AS form,
          replace({_canonical("('http://h' || chr(1) || '/' || raw)")}, 'http://h' || chr(1) || '/', '')
            AS url, reason
        FROM forms""",
    "resolve_links": f"""WITH {_PAGES}, {_links("p", "l")}
        SELECT page_id, pos, resolved FROM l""",
    "content_hash": "SELECT doc_id, sha256(nullif(text, '')) AS content_hash FROM documents",
    "attempt_errors": f"""WITH {_EVENTS}
        SELECT event_id, success, CASE WHEN error_message LIKE '%timed out%' THEN 'timeout'
               WHEN error_message <> '' THEN 'request_error' END AS error_type FROM attempts""",
    "page_titles": f"""WITH {_PAGES} SELECT page_id, title,
        nullif(regexp_extract(html, '<meta name="description" content="([^"]*)"', 1), '')
          AS meta_description FROM p_text""",
    "page_text": f"WITH {_PAGES} SELECT page_id, text_content FROM p_text",
    "page_links": f"""WITH {_PAGES}, {_links("p", "l")}
        SELECT page_id, pos, to_url, anchor_text, {_internal("to_url")} AS is_internal FROM l""",
    "upsert_urls": rf"""WITH {_PAGES}, {_links("p", "l")}
        SELECT to_url AS url, regexp_extract(to_url, '^([a-z]+):', 1) AS scheme,
               {_host("to_url")} AS host, {_path("to_url")} AS path,
               regexp_extract(to_url, '\?(.*)$', 1) AS query,
               {_internal("to_url")} AS is_internal, min(fetched_at) AS discovered_at
        FROM l WHERE to_url NOT IN (SELECT url FROM p) GROUP BY to_url""",
    "dedup_content": """
        SELECT doc_id, content_hash FROM (
          SELECT doc_id, sha256(text) AS content_hash,
                 row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS copy
          FROM documents
        ) WHERE copy = 1""",
    "page_rows": f"""WITH {_PAGES}
        SELECT url, fetched_at, raw_url AS final_url,
               CASE WHEN contains(html, '</html>') THEN 200 ELSE 206 END AS http_status,
               'text/html; charset=utf-8' AS content_type, strlen(html)::BIGINT AS content_length,
               content_hash, NULL::INTEGER AS response_time_ms, title,
               NULL::VARCHAR AS meta_description, html, text_content, true AS is_html
        FROM stored""",
    "load_seeds": f"""WITH {_PAGES}
        SELECT url, 'queued' AS status, 0 AS depth, 10 AS priority,
               NULL::VARCHAR AS discovered_from, min(fetched_at) AS next_fetch_at,
               0 AS attempt_count, NULL::VARCHAR AS last_error, min(fetched_at) AS created_at,
               min(fetched_at) AS updated_at
        FROM p WHERE NOT {_internal("url")} GROUP BY url""",
    "expand_frontier": f"""{_TABLES}
        SELECT url, status, depth, priority, discovered_from, seen_at AS next_fetch_at,
               0 AS attempt_count, NULL::VARCHAR AS last_error, seen_at AS created_at, seen_at AS updated_at
        FROM t_frontier WHERE depth > 0""",
    "link_graph": f"""{_TABLES}
        SELECT from_url, pos, to_url, anchor_text, is_internal, nofollow FROM t_links""",
    "bfs_depth": f"{_LEVELS} SELECT url, depth FROM levels",
    "discovery_tree": f"""{_LEVELS},
        parents AS (
          SELECT c.url, c.depth, min(f.url) AS discovered_from
          FROM levels c LEFT JOIN edges e ON e.to_url = c.url
          LEFT JOIN levels f ON f.url = e.from_url AND f.depth = c.depth - 1
          GROUP BY c.url, c.depth
        )
        SELECT a.url, a.depth, a.discovered_from,
               CASE a.depth WHEN 0 THEN a.url WHEN 1 THEN b.url || ' > ' || a.url
                    ELSE b.discovered_from || ' > ' || b.url || ' > ' || a.url END AS path
        FROM parents a LEFT JOIN parents b ON b.url = a.discovered_from""",
    "next_batch": f"""WITH {_EVENTS},
        daily AS (
          SELECT * REPLACE ('https://u' || url || '.example.com/en/'
                            || strftime(attempted_at, '%Y%m%d') || '/' AS url) FROM attempts
        ), {_states("daily")},
        candidates AS (
          SELECT *, CASE WHEN attempt_count = 1 THEN 1 ELSE 0 END AS depth FROM states
        )
        SELECT url, {_host("url")} AS host, 'fetching' AS status,
               CASE depth WHEN 0 THEN 10 ELSE 100 END AS priority, depth, next_fetch_at
        FROM candidates
        WHERE status = 'queued' AND next_fetch_at <= TIMESTAMP '2024-01-15 00:00:00'
        ORDER BY priority, depth, url LIMIT 50""",
    "politeness_slots": f"""WITH {_PAGES}, {_links("p", "l")},
        nodes AS (
          SELECT url, min(depth) AS depth FROM (
            SELECT url, 0 AS depth FROM p UNION ALL SELECT to_url, 1 FROM l
          ) GROUP BY url
        ),
        slots AS (
          SELECT url, {_host("url")} AS host,
                 row_number() OVER (PARTITION BY {_host("url")} ORDER BY depth, url) - 1 AS slot
          FROM nodes
        )
        SELECT url, host, slot::BIGINT AS slot,
               slot * CASE WHEN suffix(host, 'example.com') THEN 10 ELSE 3 END AS offset_sec
        FROM slots""",
    "politeness_audit": f"""WITH {_EVENTS},
        log AS (
          SELECT event_id, url AS host, attempted_at,
                 lag(attempted_at) OVER (PARTITION BY url ORDER BY attempted_at, event_id)
                   AS previous_at
          FROM attempts
        )
        SELECT *, date_diff('microsecond', previous_at, attempted_at) AS elapsed_us
        FROM log WHERE attempted_at < previous_at + INTERVAL 600 SECOND""",
    "frontier_state": f"WITH {_EVENTS}, {_states('attempts')} SELECT * FROM states",
    "attempt_rows": f"""WITH {_EVENTS}
        SELECT url, attempted_at, success, http_status,
               CASE WHEN error_message LIKE '%timed out%' THEN 'timeout'
                    WHEN error_message <> '' THEN 'request_error' END AS error_type,
               error_message, response_time_ms FROM attempts""",
    "page_budget": """
        WITH outcomes AS (
          SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1
                         THEN 'page' ELSE 'duplicate' END AS outcome
          FROM documents
        )
        SELECT doc_id, outcome FROM (
          SELECT *, coalesce(sum(CASE WHEN outcome = 'page' THEN 1 ELSE 0 END) OVER
            (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM outcomes
        ) WHERE before < 500""",
    "apply_results": f"""
        WITH ended AS (
          SELECT 'https://www.example.com/en/' || doc_id || '/' AS url, text, lang, source,
                 {_START} + to_seconds(doc_id)
                   + to_days(CASE source WHEN 'src1' THEN 1 WHEN 'src2' THEN 2 ELSE 0 END)
                   AS decided_at
          FROM documents
        ),
        ranked AS (
          SELECT *, row_number() OVER (
            PARTITION BY text, source IN ('src0', 'src2') OR lang = 'de' ORDER BY decided_at, url
          ) AS copy FROM ended
        )
        SELECT url, CASE source WHEN 'src0' THEN 'queued' WHEN 'src2' THEN 'failed' ELSE 'done' END
                 AS status,
               CASE WHEN source = 'src0' THEN 'retry' WHEN source = 'src2' THEN 'gave up'
                    WHEN lang = 'de' THEN 'other page' WHEN copy > 1 THEN 'duplicate'
                    ELSE 'page' END AS outcome,
               decided_at
        FROM ranked""",
    "hub_count": f"{_TABLES} {_HUBS}",
    "article_count": f"{_TABLES} {_ARTICLES}",
    "page_total": f"{_TABLES} {_TOTAL}",
    "links_by_type": f"{_TABLES} {_BY_TYPE}",
    "frontier_status": f"{_TABLES} {_STATUSES}",
    "top_external_hosts": f"{_TABLES} {_EXTERNAL_HOSTS}",
    "top_anchors": f"{_TABLES} {_ANCHORS}",
    "http_status_hist": f"{_TABLES} {_HTTP}",
    "depth_status": f"{_TABLES} {_DEPTHS}",
    "top_linking_titles": f"{_TABLES} {_TITLES}",
    "crawl_report": f"{_TABLES} {_REPORT}",
}
# Kinds of link put before each page: one target is stored, one has no host, one cannot be parsed.
SQL["page_descriptions"] = "SELECT page_id, 'About page ' || page_id AS meta_description FROM pages"
SQL["rejected_links"] = """
    SELECT page_id, unnest(['http://:80/x', 'http://[x']) AS href,
           unnest(['no host', 'malformed']) AS reason FROM pages"""
SQL["mixed_links"] = f"""
    SELECT page_id, (pos + 2)::INTEGER AS pos, to_url, anchor_text, is_internal
    FROM ({SQL["page_links"]})
    UNION ALL
    SELECT page_id, 0, 'http://cdn.example.org/f' || page_id || '/?a=1&b=2', 'cdn', false FROM pages"""

_ALLOWED = f"""({_internal("url")} AND NOT starts_with({_path("url")}, '/es/'))"""
SQL["robots_blocked"] = f"""
    SELECT url, {_START} + to_seconds(page_id) AS attempted_at, {_ALLOWED} AS success,
           CASE WHEN {_ALLOWED} THEN CASE WHEN contains(html, '</html>') THEN 200 ELSE 206 END END
             AS http_status,
           CASE WHEN NOT {_ALLOWED} THEN 'request_error' END AS error_type,
           CASE WHEN NOT {_ALLOWED} THEN 'Blocked by robots.txt' END AS error_message,
           NULL::INTEGER AS response_time_ms
    FROM pages"""

SQL["next_batch_again"] = f"""
    SELECT url, host, status, priority, depth
    FROM ({SQL["next_batch"].replace("LIMIT 50", "LIMIT 50 OFFSET 10")})"""

# Three levels written out, because a level depends on the contents of all before it.
_ROOT = "regexp_extract(url, '^([a-z]+://[^/]*/)', 1)"


def _level(number: int, earlier: str) -> str:
    return f"""
l{number} AS (
  SELECT e.to_url AS url, min(e.from_url) AS discovered_from
  FROM edges e JOIN k{number - 1} k ON k.url = e.from_url
  WHERE e.to_url NOT IN ({earlier}) GROUP BY e.to_url
)"""


SQL["bfs_pruned"] = f"""{_LEVELS.split("walk AS")[0]}
contents AS (
  SELECT url, min(content) AS content FROM (
    SELECT url, 'text ' || (page_id % 5) AS content FROM p
    UNION ALL SELECT {_ROOT}, 'root ' || (length({_ROOT}) % 3) FROM p
  ) GROUP BY url
),
l0 AS (SELECT DISTINCT url FROM p WHERE url LIKE '%/de/%'),
k0 AS (SELECT content, min(url) AS url FROM contents SEMI JOIN l0 USING (url) GROUP BY content),
{_level(1, "SELECT url FROM l0")},
k1 AS (
  SELECT content, min(url) AS url FROM contents SEMI JOIN l1 USING (url)
  WHERE content NOT IN (SELECT content FROM k0) GROUP BY content
),
{_level(2, "SELECT url FROM l0 UNION SELECT url FROM l1")}
SELECT url, 0 AS depth, NULL::VARCHAR AS discovered_from FROM l0
UNION ALL SELECT url, 1, discovered_from FROM l1
UNION ALL SELECT url, 2, discovered_from FROM l2"""

# The batch of pages in which no URL with a 7 in it is ever reached.
_SOME = _TABLES.replace("FROM p_text", "FROM p_text WHERE url NOT LIKE '%7%'")
_FETCHES = """
fetches AS (
  SELECT page_id AS event_id, url, fetched_at AS attempted_at, url NOT LIKE '%7%' AS success,
         CASE WHEN url LIKE '%7%' THEN 'network failure' END AS error_message,
         CASE WHEN url NOT LIKE '%7%' THEN
           CASE WHEN contains(html, '</html>') THEN 200 ELSE 206 END END AS http_status
  FROM p
)"""
SQL["applied_links"] = f"""{_SOME}
    SELECT from_url, pos, to_url, anchor_text, is_internal, nofollow FROM t_links"""
SQL["applied_urls"] = rf"""{_SOME}
    SELECT to_url AS url, regexp_extract(to_url, '^([a-z]+):', 1) AS scheme,
           {_host("to_url")} AS host, {_path("to_url")} AS path,
           regexp_extract(to_url, '\?(.*)$', 1) AS query,
           {_internal("to_url")} AS is_internal, min(fetched_at) AS discovered_at
    FROM l WHERE to_url NOT IN (SELECT url FROM p) GROUP BY to_url"""
SQL["applied_attempts"] = f"""WITH {_PAGES}, {_FETCHES}
    SELECT url, attempted_at, success, http_status,
           CASE WHEN NOT success THEN 'request_error' END AS error_type, error_message,
           NULL::INTEGER AS response_time_ms FROM fetches"""
SQL["applied_frontier"] = f"""{_SOME}, {_FETCHES}, {_states("fetches")},
    used AS (
      SELECT url, max(attempted_at) AS updated_at FROM running
      WHERE successes_before = 0 AND failures_before < 3 GROUP BY url
    )
    SELECT url, s.status, 0 AS depth, 10 AS priority, NULL::VARCHAR AS discovered_from,
           coalesce(s.next_fetch_at, t.seen_at) AS next_fetch_at, s.attempt_count, s.last_error,
           t.seen_at AS created_at, u.updated_at
    FROM states s JOIN t_seeds t USING (url) JOIN used u USING (url)
    UNION ALL
    SELECT url, status, depth, priority, discovered_from, seen_at, 0, NULL, seen_at, seen_at
    FROM t_frontier WHERE depth > 0"""

# Every seed is fetched in the batch, so the updated snapshot holds the batch's frontier rows.
SQL["snapshot_frontier"] = SQL["applied_frontier"]

# A stream gives what the batch gives.
SQL["stream_ingest"] = SQL["page_rows"]
SQL["stream_frontier_state"] = SQL["frontier_state"]
SQL["stream_report"] = SQL["crawl_report"]
