"""What DuckDB makes of the same tables, for each query of queries.py, said from the rows themselves."""

from __future__ import annotations

_HOST = "regexp_extract({u}, '^https?://([^/?#]+)', 1)"
#: A-Z and so on in one form: scheme and host in lower case, path without slashes at its end, parameters sorted and without tracking ones.
_CANON = r"""(lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || lower(regexp_extract({u}, '^[^:]+://([^/?#]*)', 1))
 || coalesce(nullif(regexp_replace(regexp_extract({u}, '^[^:]+://[^/?#]*([^?#]*)', 1), '/+$', ''), ''), '/')
 || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(regexp_extract({u}, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND lower(split_part(p, '=', 1)) NOT IN ('fbclid','gclid','igshid','ref','mc_cid','mc_eid')
      AND NOT starts_with(lower(split_part(p, '=', 1)), 'utm_') AND NOT starts_with(lower(split_part(p, '=', 1)), 'mc_'))), '&'), ''), ''))"""
_SLUG = "coalesce(nullif(regexp_replace(substr(regexp_replace(regexp_replace(lower(trim({t})), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), '-+$', ''), ''), 'recipe')"
_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_HREFS = r"""regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)"""
_PATHS = r"""regexp_extract_all(array_to_string(regexp_extract_all(html, '(?s)<script[^>]*>(.*?)</script>', 1), chr(10)), '"(/[A-Za-z0-9][^"\\\s]*)"', 1)"""
_ABS = """(CASE WHEN starts_with(h, '//') THEN 'https:' || h WHEN starts_with(h, '/') THEN regexp_extract(url, '^(https?://[^/]+)', 1) || h ELSE h END)"""
_LINKS = f"""raw AS (SELECT page_id, url, unnest(hs) AS h0, generate_subscripts(hs, 1) AS pos FROM (SELECT page_id, url, list_concat({_HREFS}, {_PATHS}) AS hs FROM pages)),
cut AS (SELECT *, split_part(split_part(h0, '#', 1), '?', 1) AS h FROM raw),
full_ AS (SELECT page_id, url, pos, {_ABS} AS f FROM cut),
links AS (SELECT page_id, url, pos, CASE WHEN ends_with(f, '/') AND length(f) - length(replace(f, '/', '')) > 3 THEN regexp_replace(f, '/+$', '') ELSE f END AS link
          FROM full_ WHERE starts_with(f, 'http'))"""
_ISO = "(CASE WHEN {m} > 0 THEN 'PT' || CASE WHEN {m} // 60 > 0 THEN ({m} // 60) || 'H' ELSE '' END || CASE WHEN {m} % 60 > 0 THEN ({m} % 60) || 'M' ELSE '' END ELSE '' END)"
_BACKOFF = "(CASE WHEN {n} >= 5 THEN 30 ELSE CAST(pow(2, {n}) AS INT) END)"
_FAILS = f"f AS (SELECT user_id, count(*) AS attempts, max(ts) AS last FROM events WHERE event_type = 'error' GROUP BY user_id), g AS (SELECT *, last + to_days({_BACKOFF.format(n='attempts')}) AS next_retry FROM f)"
#: The ingredients and steps from which a caption was made, in their order.
_ITEMS = "x AS (SELECT l_orderkey, p_name, CAST(l_quantity AS INT) AS q, strftime(l_shipdate, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_quantity AS INT), p_name, strftime(l_shipdate, '%Y-%m-%d')) AS n, count(*) OVER (PARTITION BY l_orderkey) AS c FROM lineitem JOIN part ON l_partkey = p_partkey)"
_HASH = "sha1(concat_ws('␟', {a}, {b}, {c}, {d}))"


def _page_key(source: str = "'pages'", url: str = "url") -> str:
    return f"sha1({source} || '|' || {_CANON.format(u=url)})"


def _ranked(group: str, date: str, ties: str, cap: int, table: str, columns: str) -> str:
    return f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {date} DESC, {ties}) AS rank FROM {table}) WHERE rank <= {cap}"


def oracle_sql() -> dict[str, str]:
    c = _CANON.format(u="url")
    out = {
        "canonical_urls": f"SELECT page_id, {c} AS canonical FROM pages",
        "dedup_keys": f"SELECT page_id, {_page_key()} AS dedup_key FROM pages",
        "first_seen_refs": f"SELECT {c} AS ref, min(page_id) AS page_id FROM pages GROUP BY 1",
        "title_slugs": f"SELECT page_id, {_SLUG.format(t=_TITLE)} AS slug FROM pages",
        "page_paths": f"SELECT page_id, 'recipes/pages/' || {_SLUG.format(t=_TITLE)} || '-' || substr({_page_key()}, 1, 8) || '.html' AS path FROM pages",
        "latest_per_host": f"""WITH p AS (SELECT page_id, {_TITLE} AS title, {c} AS ref FROM pages), o AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY ref ORDER BY page_id) = 1),
            h AS (SELECT *, {_HOST.format(u='ref')} AS host, sha1({_HOST.format(u='ref')} || '|' || ref) AS k FROM o)
            SELECT host, row_number() OVER (PARTITION BY host ORDER BY page_id DESC)::INT AS rank, page_id, k AS dedup_key,
            'recipes/' || host || '/' || {_SLUG.format(t='title')} || '-' || substr(k, 1, 8) || '.html' AS path FROM h QUALIFY row_number() OVER (PARTITION BY host ORDER BY page_id DESC) <= 50""",
        "page_links": f"SELECT page_id, generate_subscripts(hs, 1) - 1 AS pos, replace(unnest(hs), '&amp;', '&') AS href FROM (SELECT page_id, {_HREFS} AS hs FROM pages)",
        "distinct_page_links": f"WITH {_LINKS} SELECT DISTINCT page_id, link FROM links",
        "pattern_links": f"WITH {_LINKS} SELECT DISTINCT page_id, link FROM links WHERE regexp_matches(link, '/[Tt]he?r?')",
        "harvested_links": f"""WITH {_LINKS}, s AS (SELECT {_HOST.format(u='url')} AS source, link AS ref, min({{'p': page_id, 'n': pos}}) AS place FROM links GROUP BY 1, 2)
            SELECT source, row_number() OVER (PARTITION BY source ORDER BY place) - 1 AS ord, ref FROM s""",
        "link_absolutize": """SELECT page_id, pos, CASE pos WHEN 0 THEN o || '/a/b' WHEN 1 THEN 'https://cdn.example.com/z' WHEN 2 THEN 'https://o.example.com/p/q' WHEN 3 THEN 'mailto:a@b' ELSE o || '/' END AS link
            FROM (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS o, unnest([0, 1, 2, 3, 4])::BIGINT AS pos FROM pages)""",
        "feed_per_source": _ranked("event_type", "ts", "event_id", 50, "events", "event_type, rank, event_id"),
        "feed_combined": _ranked("1", "o_orderdate", "o_orderpriority, o_orderkey", 100, "orders", "rank, o_orderkey"),
        "feed_per_category": _ranked("o_orderpriority", "o_orderdate", "o_orderkey", 100, "orders", "o_orderpriority, rank, o_orderkey"),
        "feed_date_fallback": "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END, ts, TIMESTAMP '2001-01-01') AS sort_date FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS ts FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey",
        "in_feed_flags": """SELECT event_id, (row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) <= 50 OR row_number() OVER (ORDER BY ts DESC, event_id) <= 100) AS in_feed FROM events""",
        "source_counts": "SELECT source, count(*) AS items FROM documents GROUP BY source",
        "category_rollup": "SELECT lang AS category, source AS name, count(*)::BIGINT AS items FROM documents GROUP BY ROLLUP (lang, source) HAVING lang IS NOT NULL",
        "roster_left_join_counts": "SELECT n_regionkey::VARCHAR AS category, n_name AS name, count(s_suppkey) AS items FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2",
        "new_refs_anti": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "suppressed_anti": f"WITH {_FAILS} SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM g WHERE next_retry > TIMESTAMP '2024-01-20')",
        "failure_backoff": f"WITH {_FAILS} SELECT user_id, attempts, next_retry FROM g",
        "failure_records": f"""WITH o AS (SELECT user_id, count(*) AS n, max(ts) AS last FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-02' GROUP BY 1),
            l AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-02'),
            s AS (SELECT user_id FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-02' AND user_id % 3 = 0),
            j AS (SELECT coalesce(o.user_id, l.user_id) AS user_id, coalesce(n, 0) + (l.user_id IS NOT NULL)::INT AS attempts, last, l.user_id IS NOT NULL AS hit FROM o FULL JOIN l ON o.user_id = l.user_id)
            SELECT user_id, attempts::BIGINT AS attempts, CASE WHEN hit THEN TIMESTAMP '2024-02-01' ELSE last END + to_days({_BACKOFF.format(n='attempts')}) AS next_retry FROM j WHERE user_id NOT IN (SELECT user_id FROM s)""",
        "run_budget": """SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n, length(source) * 3 + substr(source, 4, 2)::INT AS cap FROM documents) WHERE n <= cap""",
        "catalog_upsert": """WITH e AS (SELECT *, ts < TIMESTAMP '2024-01-03' AS early FROM events),
            o AS (SELECT user_id, arg_max(event_type, event_id) AS title, arg_max(ts, event_id) AS at FROM e WHERE early GROUP BY 1), n AS (SELECT user_id, arg_max(event_type, event_id) AS title FROM e WHERE NOT early GROUP BY 1)
            SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(n.title, o.title) AS title, CASE WHEN o.user_id IS NULL THEN '' ELSE 'p/' || o.user_id END AS page_url,
            coalesce(o.at, TIMESTAMP '2024-02-01') AS discovered_at, (n.user_id IS NOT NULL AND o.title IS DISTINCT FROM n.title) AS changed FROM o FULL JOIN n ON o.user_id = n.user_id""",
        "content_hash_changes": f"""WITH h AS (SELECT conv_id, turn, {_HASH.format(a='role', b='text', c="''", d="''")} AS content_hash FROM conversations)
            SELECT conv_id, turn, content_hash, content_hash IS DISTINCT FROM lag(content_hash) OVER (PARTITION BY conv_id ORDER BY turn) AS changed FROM h""",
        "date_backfill": "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate END, ts) AS published_at FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS ts FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1) ON o_orderkey = l_orderkey",
        "emit_decision": """WITH r AS (SELECT doc_id, doc_id % 2 = 0 AS saved, coalesce(quality = 1, NOT (doc_id % 3 > 0)) AS sure FROM documents LEFT JOIN labels USING (doc_id))
            SELECT doc_id, saved OR sure AS emit, NOT saved OR sure AS "full" FROM r""",
        "minutes_iso": f"""WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity::BIGINT AS quantity FROM lineitem), m AS (SELECT *, CASE WHEN quantity * 7 - 30 > 0 THEN quantity * 7 - 30 END AS minutes FROM d)
            SELECT *, coalesce({_ISO.format(m='minutes')}, '') AS iso FROM m""",
        "human_duration": """WITH m AS (SELECT p_partkey, p_name, p_size * 11 AS m FROM part)
            SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE concat_ws(' ', CASE WHEN m // 60 > 0 THEN (m // 60) || ' hr' END, CASE WHEN m % 60 > 0 THEN (m % 60) || ' min' END) END AS human FROM m""",
        "split_tags": """WITH t AS (SELECT p_partkey, list_concat([p_type, lower(p_type)], list_concat(string_split(p_name, ' '), [upper(p_name), p_brand])) AS ts FROM part)
            SELECT p_partkey, array_to_string(list_filter(ts, lambda x, i: list_position(list_transform(ts, lambda y: lower(y)), lower(x)) = i), ';') AS tags FROM t""",
        "nutrition_lines": "SELECT p_partkey, concat_ws(chr(10), 'Calories: ' || p_partkey || ' kcal', 'Fat: ' || p_size, CASE WHEN p_partkey % 2 = 0 THEN 'Serving size: ' || p_brand END) AS nutrition FROM part",
        "feed_summary": """SELECT o_orderkey, coalesce(nullif(concat_ws(' — ', CASE WHEN o_orderkey % 2 > 0 THEN o_orderpriority END,
            nullif(concat_ws(' · ', CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey::VARCHAR END), '')), ''), 'title') AS summary FROM orders""",
        "caption_titles": "SELECT DISTINCT l_orderkey, 'Order ' || l_orderkey AS title, '450 kcal | 30g protein' AS nutrition, 'Order ' || l_orderkey || ' 🍲 recipe in bio' AS description FROM lineitem",
        "caption_items": f"""WITH {_ITEMS} SELECT l_orderkey, n - 1 AS pos, q || 'g ' || p_name AS item FROM x
            UNION ALL SELECT DISTINCT l_orderkey, c + unnest([0, 1]), unnest(['# For the sauce', '100g sugar']) FROM x
            UNION ALL SELECT DISTINCT l_orderkey, c + 2, '' FROM x WHERE false""",
        "caption_sections": f"WITH {_ITEMS} SELECT DISTINCT l_orderkey, c + 2 AS ingredients, CASE WHEN l_orderkey % 3 > 0 THEN c + 1 ELSE 0 END AS instructions FROM x",
        "caption_steps": f"""WITH {_ITEMS} SELECT l_orderkey, n - 1 AS pos, 'Add by ' || day AS step FROM x WHERE l_orderkey % 3 > 0
            UNION ALL SELECT DISTINCT l_orderkey, c, 'Makes 4 plates when all of it is shared out' FROM x WHERE l_orderkey % 3 > 0""",
        "caption_confident": "SELECT DISTINCT l_orderkey, l_orderkey % 3 > 0 AS confident FROM lineitem",
        "caption_yield": "SELECT DISTINCT l_orderkey, 'Serves ' || (l_orderkey % 7 + 1) AS servings FROM lineitem",
        "caption_lines_documents": r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, e' \t\r')), lambda x: x <> '') AS ls FROM documents)
            SELECT doc_id, sha1(array_to_string(ls, ' ')) AS description_sha1, false AS confident FROM l""",
        "steps_numbered": r"""WITH l AS (SELECT conv_id, turn, ls, generate_subscripts(ls, 1) AS n FROM (SELECT conv_id, turn, string_split(role || ': ' || text, chr(10)) AS ls FROM conversations)),
            t AS (SELECT conv_id, turn, n, regexp_replace(ls[n], '^\s+|\s+$', '', 'g') AS text FROM l)
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, n) AS position, text FROM t WHERE text <> ''""",
        "jsonld_roundtrip": f"""SELECT p_partkey, p_name || ' </b> ' || p_partkey AS title, p_brand || chr(10) || p_type AS ingredients, 'do ' || p_size || chr(10) || 'then & stop' AS instructions,
            {_ISO.format(m='p_size')} AS total_time, CASE WHEN p_partkey % 2 = 0 THEN 'Saved;' ELSE '' END || p_type AS tags, sha1('parts|https://e.example.com/p/' || p_partkey) AS dedup_key FROM part""",
        "script_escape": "SELECT page_id, sha1(replace(replace(replace(html, '<', chr(92) || 'u003c'), '>', chr(92) || 'u003e'), '&', chr(92) || 'u0026')) AS escaped_sha1 FROM pages",
        "sitemap_parse": f"""WITH p AS (SELECT page_id, url, {_HOST.format(u='url')} AS source, CASE WHEN page_id % 4 > 0 THEN '2024-01-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') END AS lastmod FROM pages),
            o AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY source, url ORDER BY coalesce(lastmod, '') DESC, page_id) = 1)
            SELECT source, row_number() OVER (PARTITION BY source ORDER BY coalesce(lastmod, '') DESC, page_id) - 1 AS ord, url AS loc, lastmod FROM o""",
        "rss_parse": "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS ord, 'https://e.example.com/' || event_id || '?a=1&b=2' AS ref, date_trunc('second', ts) AS date_hint FROM events",
        "atom_parse": "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS ord, 'https://e.example.com/' || CASE WHEN event_id % 2 = 0 THEN 'p' ELSE 'edit' END || '/' || event_id AS ref, date_trunc('second', ts) AS date_hint FROM events",
        "date_parse_formats": "SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL WHEN event_id % 5 = 3 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END::TIMESTAMP AS parsed FROM events",
        "seed_parse": """WITH c AS (SELECT *, (conv_id % 16)::VARCHAR AS source FROM conversations)
            SELECT source, row_number() OVER (PARTITION BY source ORDER BY conv_id, turn) - 1 AS ord, 'https://www.instagram.com/p/C' || conv_id || 'x' || turn AS ref, 'C' || conv_id || 'x' || turn AS code,
            '#first line' || chr(10) || text AS caption, 'https://i.example.com/' || turn || '.jpg' AS image_url, role || ';Quick' AS tags FROM c""",
        "saved_records": """SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type ELSE 's' END AS title, CASE WHEN event_id % 2 = 0 THEN 'https://e.example.com/x' ELSE '' END AS source_url,
            CASE WHEN event_id % 5 > 0 THEN 'i2' ELSE 'i1' END AS image_url, 'au' AS author, 'A;' || event_type AS tags, sha1('saves|saved://item/' || event_id) AS dedup_key FROM events""",
        "safe_links": "SELECT page_id, CASE page_id % 3 WHEN 0 THEN upper(url) WHEN 1 THEN '' ELSE url END AS link, page_id % 3 <> 1 AS real_image FROM pages",
        "bundle_names": """WITH r AS (SELECT p_brand AS source, p_partkey AS seq, replace(p_name, ' ', '-') AS s, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) AS n FROM part)
            SELECT source, seq, s || CASE WHEN n > 1 THEN '-' || n ELSE '' END || '.json' AS file FROM r""",
        "bundle_records": f"""SELECT p_partkey, '{{"id":"' || p_partkey || '","title":"' || p_name || ' </b> ' || p_partkey || '","text":"","images":[],"categories":[' || CASE WHEN p_partkey % 2 = 0 THEN '"Saved",' ELSE '' END || '"' || p_type
            || '"],"yield":"","prepTime":"","cookTime":"","totalTime":"' || {_ISO.format(m='p_size')} || '","ingredients":"# head\\n' || p_brand || '\\n ' || p_type || '","instructions":"do ' || p_size || '\\n\\nthen & stop","notes":"","nutrition":"","link":""}}' AS record FROM part""",
        "ingredient_lines": "SELECT p_partkey, unnest([0, 1, 2])::BIGINT AS pos, unnest(['head', p_brand, p_type]) AS text, unnest([true, false, false]) AS is_header FROM part",
        "provenance_tags": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Saved;' ELSE '' END || p_type AS tags FROM part",
        "emoji_titles": "SELECT c_custkey, c_name || ' x' AS title FROM customer",
        "catalog_scan": "SELECT p_partkey, p_name || ' </b> ' || p_partkey AS title, 'recipe' AS category, '' AS saved_via, false AS in_feed, 0::BIGINT AS n_tags, true AS no_date FROM part",
    }
    cat = "(SELECT *, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END AS so, CASE WHEN event_type IN ('click', 'purchase') THEN 'recipe' ELSE 'cocktail' END AS cat FROM events WHERE event_type <> 'view')"
    parts = (("'source:' || event_type", "event_type", 50), ("'all'", "1", 100), ("'category:' || cat", "cat", 100))
    out["feeds_all"] = " UNION ALL ".join(f"SELECT * FROM ({_ranked(g, 'ts', 'so, event_id', cap, cat, f'{name} AS feed, rank, event_id')})" for name, g, cap in parts)
    from harvestry.plans import scenario_oracles

    return out | scenario_oracles.oracle_sql()
