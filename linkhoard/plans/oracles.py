"""Expected rows of the registered queries, written in SQL over ``pages``.

None of these statements parses robots.txt, sitemaps or redirects: they state what the derived
sites contain, so they are independent of the operators.
"""

from __future__ import annotations

from .queries import CRAWL_LIMIT, RANK_LIMIT, RUN_LIMIT

_SAVE = "https://web.archive.org/save/"

_CTE = {
    "d_pages": r"""
        SELECT page_id, url, host,
               row_number() OVER (PARTITION BY host ORDER BY page_id) AS rn,
               count(*) OVER (PARTITION BY host) AS n_host,
               min(page_id) OVER (PARTITION BY host) AS first_id
        FROM (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages) t""",
    "d_sources": """
        SELECT first_id AS source_id, concat('http://', host) AS source, host, first_id % 5 AS k, n_host, url AS root_url
        FROM d_pages WHERE rn = 1""",
    "d_responses": """
        SELECT p.page_id, p.url, n.url AS next_url,
               CASE p.page_id % 20 WHEN 0 THEN '404' WHEN 1 THEN '503' WHEN 2 THEN '301' WHEN 3 THEN '302'
                    WHEN 5 THEN '100' WHEN 6 THEN NULL WHEN 7 THEN '301' WHEN 8 THEN '302' ELSE '200' END AS code,
               CASE p.page_id % 20 WHEN 2 THEN n.url WHEN 3 THEN n.url WHEN 7 THEN p.url ELSE NULL END AS location,
               CASE WHEN p.page_id % 20 = 6 THEN 'SocketError' ELSE NULL END AS error_class
        FROM pages p LEFT JOIN pages n ON n.page_id = p.page_id + 1""",
    "d_links": """
        SELECT p.host, p.url AS src, c.rn % 2 AS pos, c.url AS dst
        FROM d_pages p JOIN d_pages c ON c.host = p.host AND (c.rn = 2 * p.rn OR c.rn = 2 * p.rn + 1)
        UNION ALL
        SELECT p.host, p.url, 2, r.url FROM d_pages p JOIN d_pages r ON r.host = p.host AND r.rn = 1 WHERE p.rn > 1
        UNION ALL
        SELECT p.host, p.url, 3, q.url FROM d_pages p JOIN pages q ON q.page_id = 0 WHERE p.rn = 1""",
    "d_lines": """
        SELECT s.host, s.k, CAST(l.line_no AS BIGINT) AS line_no,
               CASE WHEN l.line_no < 7 THEN l.line WHEN s.k = 1 THEN concat('sitemap: ', s.source, '/sitemap.xml')
                    ELSE concat('Sitemap: ', s.source, '/sitemap.xml') END AS line
        FROM d_sources s, (VALUES (1, '# generated'), (2, 'User-agent: *'), (3, 'Disallow: /fr/'), (4, 'Allow: /fr/8'),
               (5, 'Disallow: /*?page='), (6, 'Crawl-delay: 5'), (7, '')) l(line_no, line)
        WHERE s.k IN (0, 1, 4) AND NOT (l.line_no = 7 AND s.k = 4)
        UNION ALL
        SELECT s.host, s.k, l.line_no, l.line
        FROM d_sources s, (VALUES (1, 'User-agent: *'), (2, 'Allow: /')) l(line_no, line) WHERE s.k IN (2, 3)""",
    # Sitemap tree: page position z is entry 8^level of its document on every level it starts.
    "d_tree": """
        SELECT first_id AS source_id, host, url, rn - 1 AS z, level,
               CASE WHEN n_host <= 1 THEN 0 ELSE CAST(floor(log2(n_host - 1) / 3 + 1e-9) AS BIGINT) END AS top
        FROM d_pages, range(0, 22) r(level)
        WHERE (rn - 1) % CAST(pow(8, level) AS BIGINT) = 0
          AND level <= CASE WHEN n_host <= 1 THEN 0 ELSE CAST(floor(log2(n_host - 1) / 3 + 1e-9) AS BIGINT) END""",
    "d_entries": """
        SELECT source_id, level, top, z // CAST(pow(8, level + 1) AS BIGINT) AS number,
               z // CAST(pow(8, level) AS BIGINT) % 8 AS slot,
               concat('http://', host, CASE WHEN level = top THEN '/sitemap.xml' ELSE
                   concat('/sitemap-', level, '-', z // CAST(pow(8, level + 1) AS BIGINT), '.xml') END) AS doc_url,
               CASE WHEN level = 0 THEN url ELSE
                   concat('http://', host, '/sitemap-', level - 1, '-', z // CAST(pow(8, level) AS BIGINT), '.xml') END AS loc
        FROM d_tree""",
    "d_docs": """
        SELECT source_id, doc_url, level, top,
               CASE WHEN level > 0 THEN 'index' WHEN (source_id + number) % 3 = 2 THEN 'plain' ELSE 'urlset' END AS kind
        FROM d_entries GROUP BY ALL""",
    "d_verdicts": r"""
        SELECT p.page_id, p.url, p.host, p.rn, p.first_id,
               s.k IN (2, 3) OR NOT (regexp_matches(p.url, '^https?://[^/]+/fr/') OR contains(split_part(p.url, '#', 1), '?page='))
                   OR regexp_matches(p.url, '^https?://[^/]+/fr/8') AS allowed
        FROM d_pages p JOIN d_sources s USING (host)""",
    # What the save endpoint makes of a page.
    "d_saved": f"""
        SELECT page_id, url,
               CASE WHEN error_class IS NULL AND code <> '100' THEN code END AS code,
               CASE WHEN error_class IS NULL AND code <> '100' THEN concat('{_SAVE}', url) END AS request_url,
               CASE WHEN error_class IS NOT NULL THEN 'ClientError' WHEN code = '100' THEN 'UnknownResponseCodeError' END
                   AS error_class,
               CASE WHEN error_class IS NOT NULL THEN 'SocketError, generated'
                    WHEN code = '100' THEN concat('unknown response code 100 for {_SAVE}', url) END AS error_message
        FROM d_responses""",
    # URLs of a run with the default strategy.
    "d_auto": """
        SELECT p.first_id AS source_id, CASE WHEN s.k IN (0, 1, 4) THEN p.rn - 1 ELSE p.rn END AS ord, p.url,
               CASE WHEN s.k IN (0, 1, 4) THEN 'sitemap' ELSE 'crawl' END AS via
        FROM d_pages p JOIN d_sources s USING (host)
        UNION ALL
        SELECT source_id, 0, source, 'crawl' FROM d_sources WHERE k IN (2, 3)""",
}
_NEEDS = {
    "d_sources": ("d_pages",),
    "d_links": ("d_pages",),
    "d_lines": ("d_pages", "d_sources"),
    "d_tree": ("d_pages",),
    "d_entries": ("d_pages", "d_tree"),
    "d_docs": ("d_pages", "d_tree", "d_entries"),
    "d_verdicts": ("d_pages", "d_sources"),
    "d_saved": ("d_responses",),
    "d_auto": ("d_pages", "d_sources"),
}


def _sql(body: str, *names: str, recursive: bool = False) -> str:
    needed: list[str] = []
    for name in names:
        for each in (*_NEEDS.get(name, ()), name):
            if each not in needed:
                needed.append(each)
    relations = ", ".join(f"{n} AS ({_CTE[n]})" for n in needed)
    if not relations:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}{relations}{',' if body.lstrip().startswith('r_') else ''} {body}"


def _forms(*values: str) -> str:
    """``(page_id, form, value)`` with one row per variant of a page's URL."""
    rows = " UNION ALL ".join(
        f"SELECT page_id, url, CAST({i} AS BIGINT) AS form, {v} AS value FROM base" for i, v in enumerate(values)
    )
    return rows


def _over(base: str, select: str, *values: str) -> str:
    return f"WITH base AS ({base}), forms AS ({_forms(*values)}) SELECT page_id, form, {select} FROM forms"


_PAGES = "SELECT page_id, url FROM pages"
_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
_ORIGIN = "regexp_extract(url, '^https?://[^/?#]+')"
_PATH = "regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1)"
_FOLDER = f"regexp_replace(CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END, '[^/]*$', '')"
_PARENT = f"CASE WHEN {_FOLDER} = '/' THEN '/' ELSE regexp_replace({_FOLDER}, '[^/]*/$', '') END"
_TREE = ("d_docs",)

_RUN = f"""
    SELECT a.source_id, a.ord, a.url AS uri, d.code, d.request_url, coalesce(d.error_class,
           CASE WHEN d.url IS NULL THEN 'ClientError' END) AS error_class
    FROM {{urls}} a LEFT JOIN d_saved d ON d.url = a.url"""


def _summary(rows: str) -> str:
    return f"""
    SELECT source_id, count(*) AS n_sent, count(*) FILTER (WHERE error_class IS NULL) AS n_posted,
           count(*) FILTER (WHERE error_class IS NOT NULL) AS n_errors,
           count(*) FILTER (WHERE code = '200') AS n_success,
           count(*) FILTER (WHERE code IN ('301', '302')) AS n_redirect,
           count(*) FILTER (WHERE code IN ('404', '503')) AS n_http_error
    FROM ({rows}) GROUP BY source_id"""


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["url_list"] = """
        SELECT page_id AS source_id, CAST(0 AS BIGINT) AS ord, url FROM pages
        UNION ALL SELECT page_id, 1, concat(url, '&again') FROM pages"""
    sql["url_list_clean"] = "SELECT page_id AS source_id, url AS source FROM pages"
    bare = "regexp_replace(url, '^https?://', '')"
    sql["uri_normalize"] = _over(
        _PAGES, "value AS uri", "url", f"concat('http://', {bare})", f"concat('http://HTTP://', {bare})", "concat('x', chr(10), url)"
    )
    sql["uri_strip"] = _over(_PAGES, "value AS url", "url", "url", "url", "concat('a ', url)")
    sql["is_blank"] = _over(_PAGES, "value AS blank", "false", "true", "true", "true", "false")
    sql["url_valid"] = _over(_PAGES, "value AS valid", "true", "false", "false", "false", "true", "false", "false")
    sql["url_host"] = _over(_PAGES, "value AS host", _HOST, _HOST, _HOST, "NULL")
    path_query = "regexp_extract(url, '^https?://[^/?#]+([^#]*)', 1)"
    slashed = f"CASE WHEN {path_query} LIKE '/%' THEN {path_query} ELSE concat('/', {path_query}) END"
    sql["url_request_path"] = _over(_PAGES, "value AS request_path", slashed, "'/'", "'/?a=b'")
    sql["request_url"] = _over(
        _PAGES, "value AS request_url", f"concat('{_SAVE}', url)", f"concat('{_SAVE}', url)", f"'{_SAVE}'"
    )
    sql["code_type"] = _sql(
        """SELECT page_id, CASE WHEN code = '200' THEN 'success' WHEN code IN ('301', '302') THEN 'redirect'
                  WHEN code IN ('404', '503') THEN 'error' ELSE 'unknown' END AS code_type,
                  coalesce(code = '200', false) AS success FROM d_responses""",
        "d_responses",
    )
    sql["error_class"] = _over(
        _PAGES,
        "value AS family",
        "CASE WHEN page_id % 20 = 6 THEN 'ClientError' END",
        *["'ServerError'"] * 4,
        *["'ClientError'"] * 3,
        "'ClientError'",
        "'ServerError'",
        "'Error'",
    )
    sql["fetch_outcome"] = _sql(
        """SELECT page_id,
           CASE WHEN page_id % 20 = 6 THEN 'ClientError' WHEN page_id % 20 = 5 THEN 'UnknownResponseCodeError'
                WHEN page_id % 20 IN (2, 3, 7, 8) THEN 'follow' ELSE 'response' END AS followed,
           CASE WHEN page_id % 20 = 6 THEN 'ClientError' WHEN page_id % 20 = 5 THEN 'UnknownResponseCodeError'
                ELSE 'response' END AS kept,
           CASE WHEN page_id % 20 = 6 THEN 'ClientError' WHEN page_id % 20 = 5 THEN 'UnknownResponseCodeError'
                WHEN page_id % 20 IN (2, 3, 7, 8) THEN 'follow' WHEN page_id % 20 IN (0, 1) THEN 'ResponseError'
                ELSE 'response' END AS strict FROM pages"""
    )
    sql["fetch_join"] = _sql("SELECT page_id, url, code, location, error_class FROM d_responses", "d_responses")
    no_fragment = "split_part(url, '#', 1)"
    base = "regexp_extract(url, '^[^?#]*')"
    values = (
        "location",
        f"concat({_ORIGIN}, '/abs/x?y=1')",
        f"concat({_ORIGIN}, {_FOLDER}, 'sib.html')",
        f"concat({_ORIGIN}, {_PARENT}, 'up')",
        f"concat({_ORIGIN}, {_FOLDER}, 'b/')",
        "concat(split_part(url, ':', 1), '://other.example.org/z')",
        f"concat({base}, '?q=2')",
        f"concat({no_fragment}, '#part')",
        "url",
        "'https://other.example.org/full'",
        "NULL",
    )
    rows = " UNION ALL ".join(
        f"SELECT page_id, CAST({i} AS BIGINT) AS form, {v} AS target, "
        + (
            "CASE WHEN location IS NULL THEN 'InvalidRedirectError' END"
            if i == 0
            else ("'InvalidURIError'" if i == 10 else "NULL")
        )
        + " AS error FROM d_responses"
        for i, v in enumerate(values)
    )
    sql["redirect_target"] = _sql(rows, "d_responses")
    host, rest = "regexp_extract(url, '^https?://([^/?#]+)', 1)", "regexp_extract(split_part(url, '#', 1), '^https?://[^/?#]+(.*)$', 1)"
    path = f"CASE WHEN {rest} LIKE '/%' THEN {rest} ELSE concat('/', {rest}) END"
    keys = (
        f"concat(split_part(url, ':', 1), '://', {host}, {path})",
        f"concat(split_part(url, ':', 1), '://', {host}, {path})",
        f"concat('http://', {host}, {path})",
        f"concat('https://', {host}, {path})",
        f"concat('https://', {host}, ':80', {path})",
        f"concat('http://', {host}, '/')",
        f"concat('http://', {host}, '/?q=1')",
    )
    sql["request_key"] = " UNION ALL ".join(f"SELECT page_id, CAST({i} AS BIGINT) AS form, {key} AS key FROM pages" for i, key in enumerate(keys))
    sql["fetch_captures"] = "SELECT page_id, '200' AS code, CAST(2 AS BIGINT) AS captured_at FROM pages"
    # The root is one redirect, and n_host mod 12 follow; ten are followed at most.
    sql["redirect_keys"] = _sql(
        """SELECT host AS url, CASE WHEN n_host % 12 < 10 THEN concat('http://', host, '/hop0#top') END AS final_url,
                  CASE WHEN n_host % 12 < 10 THEN '200' END AS code, CAST(least(n_host % 12 + 1, 10) AS BIGINT) AS hops,
                  CASE WHEN n_host % 12 >= 10 THEN 'MaxRedirectError' END AS error_class
           FROM d_sources""",
        "d_sources",
    )
    sql["robots_agents"] = """
        SELECT concat('h', page_id) AS host, kind, replace(agent, '{n}', CAST(page_id AS VARCHAR)) AS agent_pattern, replace(value, '{n}', CAST(page_id AS VARCHAR)) AS value
        FROM pages, (VALUES ('Disallow', '.*', '^/early'), ('Disallow', '^bot\\-{n}', '^/x{n}'), ('Allow', '^bot\\-{n}', '(?!)'), ('Disallow', '^.*', '^/z'),
                            ('Crawl-delay', '^bot\\-{n}', '9'), ('Sitemap 0', NULL, 'http://h{n}/1.xml'), ('Sitemap 1', NULL, 'http://h{n}/2.xml')) r(kind, agent, value)"""
    sql["sitemap_dropped"] = """
        SELECT page_id AS source_id, CAST(1 AS BIGINT) AS n_documents, CAST(page_id % 4 + 1 AS BIGINT) AS n_dropped, CAST(1 AS BIGINT) AS n_urls FROM pages"""
    sql["sitemap_bodies"] = "SELECT page_id AS source_id, CAST(0 AS BIGINT) AS ord, url FROM pages"
    sql["redirect_chain"] = _sql(
        """SELECT r.url,
           CASE r.page_id % 20 WHEN 2 THEN n.next_url WHEN 3 THEN r.next_url WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN NULL
                WHEN 8 THEN NULL ELSE r.url END AS final_url,
           CASE WHEN r.page_id % 20 IN (5, 6, 7, 8) OR (r.page_id % 20 = 2 AND n.next_url IS NULL)
                     OR (r.page_id % 20 = 3 AND r.next_url IS NULL) THEN NULL
                WHEN r.page_id % 20 = 0 THEN '404' WHEN r.page_id % 20 = 1 THEN '503' ELSE '200' END AS code,
           CAST(CASE r.page_id % 20 WHEN 2 THEN CASE WHEN r.next_url IS NULL THEN 0 WHEN n.next_url IS NULL THEN 1 ELSE 2 END
                WHEN 3 THEN CASE WHEN r.next_url IS NULL THEN 0 ELSE 1 END WHEN 7 THEN 10 ELSE 0 END AS BIGINT) AS hops,
           CASE WHEN r.page_id % 20 = 5 THEN 'UnknownResponseCodeError' WHEN r.page_id % 20 = 6 THEN 'ClientError'
                WHEN r.page_id % 20 = 7 THEN 'MaxRedirectError' WHEN r.page_id % 20 = 8
                     OR (r.page_id % 20 = 2 AND n.next_url IS NULL) OR (r.page_id % 20 = 3 AND r.next_url IS NULL)
                     THEN 'InvalidRedirectError' END AS error_class
        FROM d_responses r LEFT JOIN d_responses n ON n.page_id = r.page_id + 1""",
        "d_responses",
    )

    documents = """
        SELECT host, bool_and(k IN (0, 1, 4)) AS accepted,
               concat(string_agg(line, chr(10) ORDER BY line_no), CASE WHEN min(k) IN (2, 3) THEN chr(10) ELSE '' END) AS text
        FROM d_lines GROUP BY host"""
    sql["robots_scan"] = _sql(documents, "d_lines")
    sql["robots_fetch"] = sql["robots_scan"]
    sql["robots_lines"] = _sql(
        """SELECT host, line_no, split_part(line, ':', 1) AS key, trim(substr(line, instr(line, ':') + 1)) AS value
           FROM d_lines WHERE line NOT LIKE '#%'""",
        "d_lines",
    )
    rules = r"""
        SELECT host, line_no, '^.*' AS agent_pattern, split_part(line, ':', 1) AS directive,
               CASE trim(split_part(line, ':', 2)) WHEN '/*?page=' THEN '^/.*\?page=' ELSE concat('^', trim(split_part(line, ':', 2)))
               END AS path_pattern
        FROM d_lines WHERE line LIKE 'Allow:%' OR line LIKE 'Disallow:%'"""
    sql["robots_rules"] = _sql(rules, "d_lines")
    sql["robots_group"] = _sql(
        f"""SELECT host, agent_pattern, directive, string_agg(path_pattern, chr(10) ORDER BY line_no) AS path_patterns
            FROM ({rules}) GROUP BY host, agent_pattern, directive""",
        "d_lines",
    )
    sql["robots_delays"] = _sql(
        "SELECT host, '^.*' AS agent_pattern, CAST(5 AS BIGINT) AS delay_s FROM d_sources WHERE k IN (0, 1, 4)", "d_sources"
    )
    sql["robots_others"] = _sql(
        """SELECT host, CASE k WHEN 0 THEN 'Sitemap' ELSE 'sitemap' END AS key, concat(source, '/sitemap.xml') AS value,
                  CAST(7 AS BIGINT) AS line_no FROM d_sources WHERE k IN (0, 1)""",
        "d_sources",
    )
    sql["robots_sitemaps"] = _sql(
        """SELECT host, CAST(0 AS BIGINT) AS root_pos, concat(source, '/sitemap.xml') AS sitemap_url
           FROM d_sources WHERE k = 0""",
        "d_sources",
    )
    sql["robots_allowed"] = _sql("SELECT page_id, url, allowed FROM d_verdicts", "d_verdicts")
    sql["fetch_schedule"] = _sql(
        """SELECT page_id, host, CASE WHEN k IN (0, 1, 4) THEN 5 * (rn - 1) ELSE 0 END AS start_s
           FROM d_pages JOIN d_sources USING (host)""",
        "d_sources",
    )

    sql["sitemap_kind"] = _sql(
        """SELECT doc_url, kind, CASE kind WHEN 'index' THEN 'sitemapindex' WHEN 'urlset' THEN 'urlset' END AS root_name,
                  kind = 'index' AS is_index, kind = 'urlset' AS is_urlset, kind = 'plain' AS is_plain FROM d_docs""",
        *_TREE,
    )
    sql["sitemap_parse"] = _sql(
        """SELECT doc_url, slot AS pos, loc FROM d_entries
           UNION ALL
           SELECT doc_url, max(slot) + 1, min_by(loc, slot) FROM d_entries WHERE level > 0 GROUP BY doc_url""",
        "d_entries",
    )
    sql["sitemap_plain"] = _sql(
        """SELECT doc_url, slot AS pos, loc AS url FROM d_entries JOIN d_docs USING (doc_url) WHERE kind = 'plain'""",
        *_TREE,
    )
    sql["body_decode"] = """
        SELECT page_id, CAST(f.form AS BIGINT) AS form, CASE f.form WHEN 2 THEN md5('') ELSE md5(html) END AS digest
        FROM pages, range(0, 3) f(form)"""
    sql["sitemap_expand"] = _sql("SELECT source_id, doc_url, kind, top - level AS depth FROM d_docs", *_TREE)
    sql["sitemap_urls"] = _sql("SELECT first_id AS source_id, rn - 1 AS ord, url FROM d_pages", "d_pages")
    sql["sitemap_candidates"] = _sql(
        """SELECT source_id, concat(source, e.slash) AS source, CAST(n.pos AS BIGINT) AS pos, concat(source, '/', n.name) AS candidate
           FROM d_sources, (VALUES (''), ('/')) e(slash), (VALUES (0, 'sitemap_index.xml.gz'), (1, 'sitemap-index.xml.gz'),
             (2, 'sitemap_index.xml'), (3, 'sitemap-index.xml'), (4, 'sitemap.xml.gz'), (5, 'sitemap.xml')) n(pos, name)""",
        "d_sources",
    )
    sql["sitemap_discover"] = _sql(
        """SELECT source_id, CASE k WHEN 0 THEN 'robots' WHEN 2 THEN 'self' WHEN 3 THEN 'error' ELSE 'candidate' END AS via,
                  CASE WHEN k IN (0, 1, 4) THEN n_host ELSE 0 END AS n_urls FROM d_sources""",
        "d_sources",
    )

    sql["page_links"] = """
        SELECT url AS src, pos - 1 AS pos, href, concat(regexp_extract(url, '^https?://[^/?#]+'), split_part(href, '#', 1)) AS dst
        FROM (SELECT url, unnest(hrefs) AS raw, unnest(range(1, len(hrefs) + 1)) AS pos
              FROM (SELECT url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages)) t,
             LATERAL (SELECT replace(replace(replace(replace(raw, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS href)"""
    sql["host_filter"] = _sql(
        r"""SELECT src, pos, dst FROM d_links
            WHERE regexp_extract(dst, '^https?://([^/?#]+)', 1) = 'therha.example.com'
               OR regexp_matches(regexp_extract(dst, '^https?://([^/?#]+)', 1), '\.example\.net$')
               OR regexp_matches(regexp_extract(dst, '^https?://([^/?#]+)', 1), '^(blog|www)\.')""",
        "d_links",
    )
    sql["crawl_urls"] = _sql(
        "SELECT first_id AS source_id, rn - 1 AS ord, CAST(floor(log2(rn)) AS BIGINT) AS depth, url FROM d_pages", "d_pages"
    )
    sql["crawl_bodies"] = _sql(
        """SELECT first_id AS source_id, rn - 1 AS ord, CAST(floor(log2(rn)) AS BIGINT) AS depth,
                  concat(split_part(url, '#', 1), CASE WHEN contains(url, '?') THEN '&' ELSE '?' END, 'id=', page_id) AS url
           FROM d_pages""",
        "d_pages",
    )
    sql["crawl_limit"] = sql["crawl_urls"] + f" WHERE rn <= {CRAWL_LIMIT}"
    sql["crawl_polite"] = _sql(
        """r_visited AS (
             SELECT first_id, host, rn, CAST(0 AS BIGINT) AS depth, url FROM d_verdicts WHERE rn = 1 AND allowed
             UNION ALL
             SELECT c.first_id, c.host, c.rn, v.depth + 1, c.url FROM r_visited v
             JOIN d_verdicts c ON c.host = v.host AND c.rn // 2 = v.rn WHERE c.allowed AND c.rn > 1)
           SELECT first_id AS source_id, row_number() OVER (PARTITION BY first_id ORDER BY rn) - 1 AS ord, depth, url
           FROM r_visited""",
        "d_verdicts",
        recursive=True,
    )

    ranked = f"SELECT first_id AS source_id, page_id AS ord, url, page_id FROM d_pages WHERE rn <= {RANK_LIMIT}"
    sql["limit_per_source"] = _sql(f"SELECT source_id, ord, url FROM ({ranked})", "d_pages")
    sql["submit"] = _sql(
        """SELECT page_id AS source_id, CAST(0 AS BIGINT) AS ord, concat(' ', url, chr(10)) AS uri, code, request_url,
                  CAST(NULL AS VARCHAR) AS response_error, error_class FROM d_saved""",
        "d_saved",
    )
    sql["results_all"] = _sql(
        """SELECT first_id AS source_id, page_id AS ord, s.url AS archived_url, code, error_class, error_message
           FROM d_pages JOIN d_saved s USING (page_id)""",
        "d_pages",
        "d_saved",
    )
    sql["limit_nulls"] = _sql(
        f"""SELECT source_id, ord, url FROM (
              SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ord NULLS FIRST) AS rank FROM (
                SELECT CASE WHEN first_id % 3 <> 0 THEN first_id END AS source_id,
                       CASE WHEN first_id % 3 = 0 OR page_id <> first_id THEN page_id END AS ord, url FROM d_pages))
            WHERE rank <= {RANK_LIMIT}""",
        "d_pages",
    )
    sql["submit_adapter"] = _sql(
        """SELECT first_id AS source_id, page_id AS ord, url AS uri, CASE WHEN url LIKE 'https:%' THEN '200' ELSE '403' END AS code,
                  concat('https://web.archive.org/save/', url) AS request_url, CAST(NULL AS VARCHAR) AS error_class FROM d_pages""",
        "d_pages",
    )
    every = "SELECT first_id AS source_id, page_id AS ord, url, page_id FROM d_pages"
    sql["posted"] = _sql(
        f"""SELECT source_id, ord, r.url AS uri, code, request_url FROM ({every}) r JOIN d_saved s USING (page_id)
            WHERE error_class IS NULL""",
        "d_pages",
        "d_saved",
    )
    sql["run_summary"] = _sql(
        _summary(f"SELECT source_id, code, error_class FROM ({every}) r JOIN d_saved s USING (page_id)"), "d_pages", "d_saved"
    )
    sql["submit_stream"] = _sql(
        """SELECT page_id AS source_id, CAST(0 AS BIGINT) AS ord, url AS uri, code, request_url, error_class FROM d_saved""",
        "d_saved",
    )

    sql["auto"] = _sql("SELECT source_id, ord, url, via FROM d_auto", "d_auto")
    limited = f"(SELECT * FROM d_auto WHERE ord < {RUN_LIMIT})"
    sql["archive_run"] = _sql(_RUN.format(urls="d_auto"), "d_auto", "d_saved")
    sql["archive_limited"] = _sql(_RUN.format(urls=limited), "d_auto", "d_saved")
    crawled = """(SELECT source_id, 0 AS ord, source AS url FROM d_sources UNION ALL
                  SELECT first_id, rn, url FROM d_pages)"""
    sql["archive_crawl"] = _sql(_RUN.format(urls=crawled), "d_sources", "d_saved")
    listed = "(SELECT first_id AS source_id, rn - 1 AS ord, url FROM d_pages)"
    sql["archive_sitemap"] = _sql(
        _RUN.format(urls=f"(SELECT l.* FROM {listed} l JOIN d_sources s USING (source_id) WHERE s.k IN (0, 1, 4))"),
        "d_sources",
        "d_saved",
    )
    sql["archive_urls"] = _sql(
        f"""SELECT f.source_id, f.n_found, s.* EXCLUDE (source_id) FROM
            (SELECT first_id AS source_id, count(*) AS n_found FROM d_pages GROUP BY 1) f
            JOIN ({_summary(_RUN.format(urls=listed))}) s USING (source_id)""",
        "d_pages",
        "d_saved",
    )
    sql["archive_rules"] = _sql(
        rf"""r_zero AS (SELECT host AS zero, url AS first_url FROM d_pages WHERE page_id = 0),
           r_sites AS (
             SELECT s.*, zero, source_id % 7 AS how, (source_id % 7 = 5 AND k IN (0, 1, 4)) OR source_id % 7 = 4 AS by_sitemap,
                    host <> zero AND CASE source_id % 7 WHEN 2 THEN regexp_matches(zero, '\.example\.net$')
                      WHEN 3 THEN regexp_matches(zero, '^[a-z]+.*\.com$') ELSE true END AS abroad,
                    CASE source_id % 4 WHEN 0 THEN {RUN_LIMIT} WHEN 1 THEN 1000000000 WHEN 2 THEN 3 ELSE 0 END AS most
             FROM d_sources s LEFT JOIN r_zero ON true),
           r_crawled AS (
             SELECT source_id, most, 0 AS depth, false AS away, 0 AS rn, source AS url FROM r_sites WHERE how <> 6 AND how <> 4 AND NOT by_sitemap
             UNION ALL
             SELECT s.source_id, most, 1 + floor(log2(p.rn)), false, p.rn, p.url FROM r_sites s JOIN d_pages p USING (host)
             WHERE how <> 6 AND NOT by_sitemap
             UNION ALL
             SELECT s.source_id, most, 2 + floor(log2(p.rn)), true, p.rn, p.url FROM r_sites s JOIN d_pages p ON p.host = s.zero
             WHERE how <> 6 AND NOT by_sitemap AND abroad),
           r_urls AS (
             SELECT source_id, most, row_number() OVER (PARTITION BY source_id ORDER BY depth, away, rn) - 1 AS ord, url FROM r_crawled
             UNION ALL
             SELECT s.source_id, most, p.rn - 1, p.url FROM r_sites s JOIN d_pages p USING (host) WHERE by_sitemap AND k IN (0, 1, 4)
             UNION ALL
             SELECT source_id, most, 0, source FROM r_sites WHERE how = 6)
           {_RUN.format(urls="(SELECT * FROM r_urls WHERE ord < most)")}""",
        "d_sources",
        "d_saved",
    )
    return sql
