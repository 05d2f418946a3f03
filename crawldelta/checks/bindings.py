"""Operator inputs derived from the given tables, written once in SQL for both engines.

A query and its oracle share these inputs and nothing else. Every binding reads
its whole tables; a modulus only decides which variant a row stands for. The two
inventories differ because each leaves out a tenth of the pages, as sites do
between two days; together they hold every page.

``{name}`` stands for a given table, ``<<spark|other>>`` for the few places
where the dialects differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("pages", "orders", "events", "supplier", "customer")
RUN_TS = "2025-12-02 06:00:00"
EVENTS_RUN_TS = "2024-01-31 00:00:00"

BINDINGS: dict[str, tuple[tuple[str, ...], str]] = {
    # --- S: two inventories and an all-time table over the pages -----------------
    "s_base": ((), """
        SELECT page_id, url AS loc, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS domain,
               CASE WHEN page_id % 13 = 0 THEN NULL
                    ELSE concat('2025-11-', lpad(CAST(1 + page_id % 28 AS STRING), 2, '0')) END AS lm
        FROM {pages}"""),
    "s_cur": (("s_base",), """
        SELECT domain, loc, CASE WHEN page_id % 4 = 0 THEN '2025-12-02' ELSE lm END AS lastmod,
               concat('s', CAST(page_id % 3 AS STRING)) AS sitemap_source_url, page_id AS pos
        FROM s_base WHERE page_id % 10 <> 7
        UNION ALL
        SELECT domain, loc, '2025-01-01', 's9', page_id FROM s_base
        WHERE page_id % 10 <> 7 AND page_id % 6 = 0"""),
    "s_prev": (("s_base",), """
        SELECT domain, loc, lm AS lastmod, TIMESTAMP '2025-12-01 06:00:00' AS detected_at,
               CASE WHEN page_id % 9 = 0 THEN 'modified' ELSE 'present' END AS change_type,
               concat('s', CAST(page_id % 2 AS STRING)) AS sitemap_source_url
        FROM s_base WHERE page_id % 10 <> 3"""),
    "s_prev_marked": (("s_base", "s_prev"), """
        SELECT p.domain, p.loc, p.lastmod, p.detected_at, p.sitemap_source_url,
               CASE WHEN b.page_id % 70 = 7 THEN 'removed' ELSE p.change_type END AS change_type
        FROM s_prev p JOIN s_base b ON p.loc = b.loc"""),
    "s_raw": (("s_base", "s_prev"), """
        SELECT domain, loc, lastmod, detected_at, change_type FROM s_prev
        UNION ALL
        SELECT domain, loc, '2025-10-10', TIMESTAMP '2025-11-01 06:00:00', 'present' FROM s_base
        WHERE page_id % 5 = 0
        UNION ALL
        SELECT domain, NULL, lm, TIMESTAMP '2025-12-01 06:00:00', 'present' FROM s_base
        WHERE page_id % 17 = 0"""),
    "s_all_time": (("s_base",), """
        SELECT loc, domain,
               CASE WHEN page_id % 2 = 0 THEN TIMESTAMP '2025-10-01 00:00:00'
                    ELSE TIMESTAMP '2025-11-01 00:00:00' END AS first_seen_at,
               TIMESTAMP '2025-12-01 06:00:00' AS last_seen_at,
               page_id % 10 <> 3 AS is_current_live,
               CASE WHEN page_id % 10 <> 3 THEN 'current_live' ELSE 'old_live' END AS live_status,
               lm AS last_lastmod, concat('s', CAST(page_id % 2 AS STRING)) AS last_sitemap_source_url
        FROM s_base WHERE page_id % 10 <> 3 OR page_id % 20 = 3"""),
    "s_log": (("s_base", "s_prev"), """
        SELECT p.domain, p.loc, 'discovered' AS change_type, p.detected_at FROM s_prev p
        WHERE p.domain LIKE '%.com'"""),
    # --- L: the same two inventories over the orders, for scale ------------------
    "l_cur": ((), """
        SELECT concat('s', CAST(o_custkey % 40 AS STRING), '.example.com') AS domain,
               concat('https://s', CAST(o_custkey % 40 AS STRING), '.example.com/', CAST(o_orderkey AS STRING)) AS loc,
               CASE WHEN o_orderkey % 4 = 0 THEN '2025-12-02' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS lastmod,
               concat('s', CAST(o_orderkey % 3 AS STRING)) AS sitemap_source_url, o_orderkey AS pos
        FROM {orders} WHERE o_orderkey % 10 <> 7
        UNION ALL
        SELECT concat('s', CAST(o_custkey % 40 AS STRING), '.example.com'),
               concat('https://s', CAST(o_custkey % 40 AS STRING), '.example.com/', CAST(o_orderkey AS STRING)),
               '1980-01-01', 's9', o_orderkey
        FROM {orders} WHERE o_orderkey % 10 <> 7 AND o_orderkey % 6 = 0"""),
    "l_prev": ((), """
        SELECT concat('s', CAST(o_custkey % 40 AS STRING), '.example.com') AS domain,
               concat('https://s', CAST(o_custkey % 40 AS STRING), '.example.com/', CAST(o_orderkey AS STRING)) AS loc,
               CAST(CAST(o_orderdate AS DATE) AS STRING) AS lastmod,
               TIMESTAMP '2025-12-01 06:00:00' AS detected_at, 'present' AS change_type,
               concat('s', CAST(o_orderkey % 2 AS STRING)) AS sitemap_source_url
        FROM {orders} WHERE o_orderkey % 10 <> 3"""),
    "l_all_time": (("l_prev",), """
        SELECT loc, domain, TIMESTAMP '2025-10-01 00:00:00' AS first_seen_at, detected_at AS last_seen_at,
               true AS is_current_live, 'current_live' AS live_status, lastmod AS last_lastmod,
               sitemap_source_url AS last_sitemap_source_url
        FROM l_prev"""),
    # --- P: URLs of several depths ----------------------------------------------
    "p_urls": (("s_base",), """
        SELECT page_id, domain,
               CASE page_id % 4 WHEN 0 THEN loc
                    WHEN 1 THEN concat('https://', domain, '?q=/a/b')
                    WHEN 2 THEN concat('HTTPS://', domain, '/only', CAST(page_id % 30 AS STRING), '/')
                    ELSE concat('https://', domain, '//a', CAST(page_id % 20 AS STRING), '/b/c/d?x=/y#/z') END AS loc
        FROM s_base"""),
    # --- X: sitemap documents and indexes built from the pages --------------------
    "x_entries": (("s_base",), """
        SELECT domain, page_id, CAST(floor(page_id / 200) AS BIGINT) AS shard,
               CAST(floor(page_id / 40000) AS BIGINT) AS grp, loc, lm,
               CASE WHEN page_id % 3 = 0 THEN 'daily' END AS changefreq,
               CASE WHEN page_id % 5 = 0 THEN '0.8' END AS priority
        FROM s_base"""),
    "x_sets": (("x_entries",), """
        SELECT domain, shard, grp, concat('https://', domain, '/sitemap-', CAST(shard AS STRING), '.xml') AS sitemap_url,
               concat('<?xml version="1.0" encoding="UTF-8"?>', chr(10),
                      '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">',
                      string_agg(concat('<url><loc> ', replace(loc, '&', '&amp;'), chr(10), '</loc>',
                          CASE WHEN lm IS NULL THEN '' ELSE concat('<lastmod>', lm, '</lastmod>') END,
                          CASE WHEN changefreq IS NULL THEN '' ELSE concat('<changefreq>', changefreq, '</changefreq>') END,
                          CASE WHEN priority IS NULL THEN '' ELSE concat('<priority>', priority, '</priority>') END,
                          '</url>'), ''<<) WITHIN GROUP (ORDER BY page_id)| ORDER BY page_id)>>,
                      '</urlset>') AS xml
        FROM x_entries GROUP BY domain, shard, grp"""),
    "x_groups": (("x_sets",), """
        SELECT domain, grp, concat('https://', domain, '/index-', CAST(grp AS STRING), '.xml') AS sitemap_url,
               concat('<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><!-- up --><sitemap><loc>https://',
                      domain, '/sitemap.xml</loc></sitemap>',
                      string_agg(concat('<sitemap><loc>', sitemap_url, '</loc><lastmod>2025-12-0',
                          CAST(1 + shard % 9 AS STRING), '</lastmod></sitemap>'), ''<<) WITHIN GROUP (ORDER BY shard)| ORDER BY shard)>>,
                      '</sitemapindex>') AS xml
        FROM x_sets GROUP BY domain, grp"""),
    "x_roots": (("x_groups",), """
        SELECT domain, concat('https://', domain, '/sitemap.xml') AS sitemap_url,
               concat('<sm:sitemapindex xmlns:sm="http://www.sitemaps.org/schemas/sitemap/0.9"><sm:sitemap><sm:loc>https://',
                      domain, '/missing.xml</sm:loc></sm:sitemap><sm:sitemap><sm:loc> </sm:loc></sm:sitemap>',
                      string_agg(concat('<sm:sitemap><sm:loc>', sitemap_url, '</sm:loc></sm:sitemap>'), ''<<) WITHIN GROUP (ORDER BY grp)| ORDER BY grp)>>,
                      '</sm:sitemapindex>') AS xml
        FROM x_groups GROUP BY domain"""),
    "x_docs": (("x_sets", "x_groups", "x_roots"), """
        SELECT domain, sitemap_url, xml, TIMESTAMP '2025-12-02 05:00:00' AS fetched_at FROM x_sets
        UNION ALL SELECT domain, sitemap_url, xml, TIMESTAMP '2025-12-02 05:00:00' FROM x_groups
        UNION ALL SELECT domain, sitemap_url, xml, TIMESTAMP '2025-12-02 05:00:00' FROM x_roots
        UNION ALL SELECT domain, concat(sitemap_url, '?orphan'), xml, TIMESTAMP '2025-12-02 05:00:00' FROM x_sets
        UNION ALL SELECT domain, concat(sitemap_url, '?cut'), substr(xml, 1, length(xml) - 12), TIMESTAMP '2025-12-02 05:00:00' FROM x_sets
        UNION ALL SELECT domain, concat(sitemap_url, '?void'), '', TIMESTAMP '2025-12-02 05:00:00' FROM x_roots"""),
    # The same sitemaps with faults: a commented entry, a bare sign, an unknown reference, a control character, CDATA, half an entry.
    "x_faulty": (("x_sets",), """
        SELECT domain, sitemap_url, replace(xml, '</urlset>', concat('<!-- <url><loc>https://no.example/</loc></url> -->',
                   '<url><loc>https://', domain, '/lt?a<b&c=1&amp;d=2</loc></url><url><loc>https://', domain, '/caf&eacute;</loc></url>',
                   '<url><loc>https://', domain, '/c', chr(1), 'trl</loc></url>',
                   '<url><loc><![CDATA[https://', domain, '/?x=1&amp;y=2]]></loc><lastmod>2025</lastmod></url>',
                   '<url><loc>https://', domain, '/half</urlset>')) AS xml,
               TIMESTAMP '2025-12-02 05:00:00' AS fetched_at
        FROM x_sets"""),
    # --- H: pages with the tags the page checks look for -------------------------
    "h_pages": ((), """
        SELECT page_id, url, CASE WHEN page_id % 11 = 0 THEN 404 ELSE 200 END AS content_status_code,
               replace(html, '<head>', concat('<head>', CASE page_id % 9
                   WHEN 1 THEN '<meta name="description" content="Plain &amp; simple page">'
                   WHEN 2 THEN '<meta content="index, NOINDEX" name="Robots">'
                   WHEN 3 THEN concat('<link rel="canonical" href="', url, '/">')
                   WHEN 4 THEN '<link href="https://other.example.org/x" rel=canonical>'
                   WHEN 5 THEN '<meta property="og:title" content="OG title"><meta property="og:description" content="OG text">'
                   WHEN 6 THEN '<script type="application/ld+json">{"@type":"Article","author":{"@type":"Person"}}</script><script type="application/ld+json">{bad</script>'
                   WHEN 7 THEN '<script type="application/ld+json">[{"@type":"Product"},{"name":"x"},{"@type":"Offer"}]</script>'
                   WHEN 8 THEN '<!-- <meta name="robots" content="none"> --><meta name="robots" content="max-image-preview:none">'
                   ELSE '' END)) AS html
        FROM {pages}"""),
    # --- O: probe results over the events ---------------------------------------
    "o_probes": ((), """
        SELECT event_id, concat('d', CAST(user_id % 10 AS STRING)) AS domain,
               concat('https://d', CAST(user_id % 10 AS STRING), '.example.com/u/', CAST(user_id AS STRING)) AS url,
               CASE event_id % 3 WHEN 0 THEN 'removed' WHEN 1 THEN 'discovered' ELSE 'modified' END AS change_type,
               CASE user_id % 3 WHEN 0 THEN 'news' WHEN 1 THEN 'blog' END AS section,
               CAST(CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 301 WHEN 'purchase' THEN 404 WHEN 'error' THEN 0
                    ELSE CASE event_id % 5 WHEN 0 THEN 410 WHEN 1 THEN 403 WHEN 2 THEN 429 WHEN 3 THEN 503 ELSE 418 END END AS INT) AS status_code,
               event_type = 'click' AS is_redirect,
               CASE WHEN event_type = 'click' THEN CASE WHEN event_id % 2 = 0
                    THEN concat('https://d', CAST(user_id % 10 AS STRING), '.example.com/new/', CAST(event_id AS STRING))
                    ELSE concat('https://other.example.org/', CAST(event_id AS STRING)) END END AS final_url,
               CASE WHEN event_type = 'error' THEN NULL ELSE value END AS response_time_ms,
               CAST(ts AS TIMESTAMP) AS checked_at, props,
               CASE event_id % 7 WHEN 0 THEN 'noindex' WHEN 1 THEN 'NoFollow' WHEN 2 THEN 'none'
                    WHEN 3 THEN 'max-image-preview:none' WHEN 4 THEN 'NOINDEX, nofollow' WHEN 5 THEN '' END AS h_x_robots_tag
        FROM {events}"""),
    "o_settings": (("o_probes",), """
        SELECT domain, CAST(CASE WHEN domain IN ('d0', 'd2', 'd4', 'd6') THEN 0.27 ELSE 0.5 END AS DOUBLE) AS failure_threshold,
               CAST(CASE WHEN domain IN ('d0', 'd1') THEN 7 ELSE 3 END AS INT) AS backoff_days, domain <> 'd5' AS enabled
        FROM (SELECT DISTINCT domain FROM o_probes) d"""),
    # --- C: a change log over the events ----------------------------------------
    "c_changes": ((), """
        SELECT concat('d', CAST(user_id % 10 AS STRING)) AS domain,
               concat('https://d', CAST(user_id % 10 AS STRING), '.example.com/u/', CAST(user_id AS STRING)) AS loc,
               CASE event_type WHEN 'signup' THEN 'discovered' WHEN 'error' THEN 'removed'
                    WHEN 'purchase' THEN 'present' ELSE 'modified' END AS change_type,
               CAST(ts AS TIMESTAMP) AS detected_at,
               CASE user_id % 3 WHEN 0 THEN 'news' WHEN 1 THEN 'blog' ELSE 'docs' END AS section
        FROM {events}"""),
    "c_settings": (("c_changes",), """
        SELECT domain, domain <> 'd1' AS check_removed, domain <> 'd2' AS check_new, domain <> 'd3' AS check_updated,
               CAST(CASE domain WHEN 'd4' THEN 3 WHEN 'd5' THEN 100000 ELSE 5 END AS INT) AS max_per_run
        FROM (SELECT DISTINCT domain FROM c_changes) d WHERE domain <> 'd9'"""),
    # --- R: robots texts over the suppliers --------------------------------------
    "r_robots": ((), """
        SELECT concat('www.site', CAST(s_suppkey AS STRING), '.example.com') AS domain,
               CASE s_suppkey % 8
                   WHEN 0 THEN concat('User-agent: *', chr(10), 'Disallow: /private', chr(10), chr(10), 'User-agent: GPTBot', chr(10), 'Disallow: /')
                   WHEN 1 THEN concat('# all', chr(10), 'user-AGENT: *', chr(10), 'DISALLOW: /')
                   WHEN 2 THEN concat('User-agent: CCBot', chr(10), 'User-agent: ClaudeBot', chr(10), 'Disallow: /', chr(10), 'Disallow: /x')
                   WHEN 3 THEN concat('User-agent: Claude-Web', chr(13), chr(10), 'Disallow:', chr(13), chr(10), ' Disallow:/ ', chr(13), chr(10))
                   WHEN 4 THEN concat('Disallow: /', chr(10), 'User-agent: PerplexityBot', chr(10), 'Disallow: /thmb/', chr(10), '# Disallow: /', chr(10), 'Disallow: / # all')
                   WHEN 5 THEN ''
                   WHEN 6 THEN concat('User-agent: Googlebot', chr(10), 'Allow: /', chr(10), 'Disallow: /', chr(10), 'User-agent: Perplexity-User', chr(10), '  disallow :/', chr(10), 'Disallow: /', chr(10), 'User-agent:', chr(10), 'Disallow: /')
                   ELSE NULL END AS content,
               CASE WHEN s_suppkey % 5 = 0 THEN TIMESTAMP '2025-11-20 00:00:00'
                    WHEN s_suppkey % 5 = 1 THEN TIMESTAMP '2025-12-01 06:00:00'
                    ELSE TIMESTAMP '2025-12-02 00:00:00' END AS fetched_at, 200 AS status_code
        FROM {supplier}
        UNION ALL
        SELECT concat('www.site', CAST(s_suppkey AS STRING), '.example.com'),
               concat('User-agent: DuckAssistBot', chr(10), 'Disallow: /'), TIMESTAMP '2025-11-30 00:00:00', 200
        FROM {supplier}"""),
    # Two versions of the robots texts, with rules for paths and delays.
    "r_versions": (("r_robots",), """
        SELECT domain, CASE WHEN content LIKE '%DuckAssistBot%' THEN 'old' ELSE 'new' END AS version,
               CASE WHEN content LIKE '%DuckAssistBot%'
                    THEN concat(content, chr(10), 'User-agent: Slurp', chr(10), 'user-agent : no', chr(10), 'User-Agent: *', chr(10),
                                'Crawl-delay: 3', chr(10), 'Disallow: /private', chr(10), 'Allow: /private/open', chr(10), 'Disallow:')
                    ELSE concat(content, chr(10), 'User-agent: Slurp # old', chr(10), 'Disallow : /*.pdf$ # all', chr(10), 'Crawl-delay: 7',
                                chr(13), chr(10), 'Disallow: /x', chr(10), 'Allow: /x/1') END AS content
        FROM r_robots WHERE content IS NOT NULL"""),
    "r_paths": ((), """
        SELECT concat('www.site', CAST(1 + o_custkey % 10 AS STRING), '.example.com') AS domain,
               concat(CASE o_orderkey % 6 WHEN 0 THEN '/private/' WHEN 1 THEN '/private/open/' WHEN 2 THEN '/x/' WHEN 3 THEN '/thmb/' ELSE '/' END,
                      CAST(o_orderkey AS STRING), CASE o_orderkey % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.pdf?v=1' ELSE '' END) AS path
        FROM {orders}"""),
    # --- T: targets over the customers -------------------------------------------
    "t_targets": ((), """
        SELECT c_custkey AS position, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '  '
                    ELSE concat(CASE WHEN c_custkey % 3 = 0 THEN 'www.' ELSE '' END, 'site', CAST(c_custkey AS STRING), '.example.com') END AS domain,
               CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ' '
                    ELSE concat('https://site', CAST(c_custkey AS STRING), '.example.com/sitemap.xml') END AS sitemap_url,
               CASE WHEN c_custkey % 4 = 0 THEN concat('https://a.example.com/', CAST(c_custkey AS STRING), ' https://b.example.com/', CAST(c_custkey AS STRING)) END AS sitemap_list,
               CASE c_custkey % 6 WHEN 0 THEN false WHEN 1 THEN true END AS enabled,
               CAST(CASE c_custkey % 5 WHEN 0 THEN 7 WHEN 1 THEN 30 WHEN 2 THEN 1 WHEN 3 THEN 0 END AS INT) AS interval_days,
               CASE WHEN c_custkey % 10 = 3 THEN concat('agent/', CAST(c_custkey AS STRING)) WHEN c_custkey % 10 = 4 THEN '' END AS user_agent,
               CASE WHEN c_custkey % 9 = 0 THEN false END AS st_enabled,
               CASE WHEN c_custkey % 8 = 0 THEN false END AS st_check_new,
               CAST(CASE WHEN c_custkey % 3 = 0 THEN 25 END AS INT) AS st_max_per_run,
               CAST(CASE WHEN c_custkey % 4 = 1 THEN 0.7 END AS DOUBLE) AS st_failure_threshold,
               CAST(CASE WHEN c_custkey % 4 = 1 THEN 7 END AS INT) AS st_backoff_days
        FROM {customer}"""),
    # --- A: fetch attempts over the events ----------------------------------------
    "a_attempts": ((), """
        SELECT concat('d', CAST(user_id % 10 AS STRING)) AS domain, event_type AS method, value > 35 AS success,
               CAST(CASE WHEN value > 35 THEN 200 ELSE 403 END AS INT) AS status_code, CAST(ts AS TIMESTAMP) AS attempted_at,
               concat('https://d', CAST(user_id % 10 AS STRING), '.example.com/u/', CAST(user_id AS STRING), '/', CAST(event_id AS STRING)) AS url
        FROM {events}"""),
}


def _chain(names: tuple[str, ...], seen: dict[str, None]) -> dict[str, None]:
    for n in names:
        if n not in seen:
            _chain(BINDINGS[n][0], seen)
            seen[n] = None
    return seen


def _dialect(sql: str, which: int) -> str:
    return re.sub(r"<<(.*?)\|(.*?)>>", lambda m: m.group(1 + which), sql, flags=re.S)


def bind(spark: SparkSession, sf_dir: str, name: str, views: dict[str, str] | None = None) -> DataFrame:
    """A binding as a DataFrame over the tables of one folder.

    ``views`` replaces a table by a view, such as one over a stream of it.
    """
    ctes = [f"{n} AS ({_dialect(BINDINGS[n][1], 0)})" for n in _chain((name,), {})]
    sql = f"WITH {', '.join(ctes)} SELECT * FROM {name}"
    for t in TABLES:
        source = (views or {}).get(t, f"parquet.`{sf_dir}/{t}.parquet`")
        sql = sql.replace("{" + t + "}", source)
    return spark.sql(sql)


def oracle(names: str, sql: str, extra: str = "", recursive: bool = False) -> str:
    """SQL text for the other engine: the bindings as CTEs, then extra CTEs, then the query."""
    ctes = [f"{n} AS ({_dialect(BINDINGS[n][1], 1)})" for n in _chain(tuple(names.split()), {})]
    if extra:
        ctes.append(extra)
    out = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(ctes)} {sql}"
    for t in TABLES:
        out = out.replace("{" + t + "}", t)
    return out
