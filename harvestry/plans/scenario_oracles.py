"""What DuckDB makes of the same tables, for each query of scenarios.py, said from the rows themselves."""

from __future__ import annotations

from harvestry.plans.oracles import _ISO, _SLUG

_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
_HUMAN = "concat_ws(' ', CASE WHEN {m} // 60 > 0 THEN ({m} // 60) || ' hr' END, CASE WHEN {m} % 60 > 0 THEN ({m} % 60) || ' min' END)"

#: Lines of captions; # stands for a number of the row. The order is that of the query's.
_POOL = (
    "Ingredients:", "For the sauce:", "METHOD", "Macros", "you''ll need", "Directions :", "Nutrition", "per serving:",
    "- #g sugar", "• # onions", "#) stir and wait", "Step #: fold in", "1.", "Serves #", "makes # small loaves for later on", "Yield: #",
    "#0 kcal | #g protein", "about #g carbs in all of it", "#food #home", "for the best results, wait", "a line of prose #", "   ", "***", "⁠Plain words #  ",
)

#: The rules of captions as a forward fill: each line says what it is, its section is that of the last header before it.
_CAPTIONS = rf"""WITH s AS (SELECT DISTINCT l_partkey, l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS INT) AS q FROM lineitem),
raw AS (SELECT l_partkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, q) AS n, q,
          [{", ".join(f"'{x}'" for x in _POOL)}][(l_orderkey * 7 + l_linenumber * 3 + l_suppkey + q) % {len(_POOL)} + 1] AS shape FROM s
        UNION ALL SELECT DISTINCT l_partkey, 0, 0, 'Part ' || l_partkey || ' 🍲 recipe below' FROM s),
l AS (SELECT l_partkey, n, trim(replace(CASE WHEN shape = '#food #home' THEN shape ELSE replace(shape, '#', q::VARCHAR) END, chr(8288), '')) AS t FROM raw),
k AS (SELECT *, CASE WHEN regexp_matches(t, '(?i)^for\s+the\s+.{{1,40}}:$') THEN 'group'
                     WHEN regexp_matches(t, '(?i)^(ingredients?|you(''ll)?\s+need|shopping\s+list)\s*:?$') THEN 'ingredients'
                     WHEN regexp_matches(t, '(?i)^(methods?|instructions?|directions?|steps?|how\s+to|recipe)\s*:?$') THEN 'instructions'
                     WHEN regexp_matches(t, '(?i)^(macros?|nutrition|per\s+serving)\s*:?$') THEN 'nutrition' END AS kind,
          regexp_matches(t, '(?i)(\d+\s*(kcal|cal|calories))|(\d+\s*g\s*(protein|carbs?|fat|fibre|fiber|sugar))')
            AND length(regexp_replace(regexp_replace(regexp_replace(t, '(?i)\d+\s*(kcal|cal|calories|g|mg)\b', '', 'g'),
              '(?i)(protein|carbs?|carbohydrates?|fat|fibre|fiber|sugar|calories?|macros?|per\s+serving)', '', 'g'), '\W', '', 'g')) <= 3 AS macro,
          CASE WHEN length(t) <= 24 AND regexp_matches(t, '(?i)^(serves?|servings?|makes|yield)\b')
            THEN nullif(trim(regexp_extract(t, '(?i)\b(serves?|servings?|makes|yield)\b[:\s]*([0-9]+[^\n]{{0,20}})', 0)), '') END AS portion,
          coalesce(nullif(trim(regexp_replace(t, '(?i)^([-*•·▢▪◦]|\d+[.)]|step\s*\d+[:.)]?)\s*', '')), ''), t) AS bare
      FROM l WHERE t <> '' AND NOT regexp_full_match(t, '(#\w+\s*)+')),
z AS (SELECT *, coalesce(last_value(CASE kind WHEN 'group' THEN 'ingredients' ELSE kind END IGNORE NULLS) OVER (PARTITION BY l_partkey ORDER BY n ROWS UNBOUNDED PRECEDING), 'description') AS section FROM k),
r AS (SELECT l_partkey, n, t, portion, CASE WHEN kind = 'group' THEN '# ' || trim(rtrim(t, ':')) ELSE bare END AS item,
        CASE WHEN kind = 'group' THEN 'ingredients' WHEN kind IS NOT NULL THEN 'header' WHEN section = 'nutrition' OR (section <> 'ingredients' AND macro) THEN 'nutrition'
             WHEN section <> 'ingredients' AND portion IS NOT NULL THEN 'servings' ELSE section END AS part FROM z)
SELECT l_partkey, 'Part ' || l_partkey AS title, sha1(coalesce(string_agg(t, ' ' ORDER BY n) FILTER (WHERE part = 'description'), '')) AS description,
  coalesce(string_agg(item, chr(10) ORDER BY n) FILTER (WHERE part = 'ingredients'), '') AS ingredients, coalesce(string_agg(item, chr(10) ORDER BY n) FILTER (WHERE part = 'instructions'), '') AS instructions,
  coalesce(string_agg(t, chr(10) ORDER BY n) FILTER (WHERE part = 'nutrition'), '') AS nutrition, coalesce(arg_min(portion, n) FILTER (WHERE part = 'servings'), '') AS servings,
  bool_or(part = 'ingredients') AND bool_or(part = 'instructions') AS confident FROM r GROUP BY l_partkey"""

#: What three runs take up of each source: its items in order, how many the window shows and a run takes, and which give a record.
_RUNS = """o AS (
  SELECT 'web' AS source, p_partkey AS item, row_number() OVER (ORDER BY CASE WHEN p_partkey % 4 > 0 THEN '2024-01-' || lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0') ELSE '' END DESC, p_partkey) AS n, p_partkey % 7 > 0 AS ok, 120 AS look, 40 AS cap FROM part WHERE p_partkey % 10 < 9
  UNION ALL SELECT 'posts', c_custkey, row_number() OVER (ORDER BY c_custkey), c_custkey % 11 <> 5, 1000000000, 40 FROM customer
  UNION ALL SELECT 'fed', s_suppkey, row_number() OVER (ORDER BY s_suppkey), true, 30, 5 FROM supplier
  UNION ALL SELECT 'listed', s_suppkey, row_number() OVER (ORDER BY s_suppkey), true, 120, 40 FROM supplier
  UNION ALL SELECT 'kept', s_suppkey, row_number() OVER (ORDER BY s_suppkey), s_suppkey % 5 > 0, 30, 7 FROM supplier),
w AS (SELECT *, (n - 1) // cap AS run FROM o WHERE n <= look),
a AS (SELECT * FROM w WHERE run < CASE source WHEN 'posts' THEN 3 ELSE 2 END)"""


def oracle_sql() -> dict[str, str]:
    minute = "date_trunc('minute', ts)"
    cards = f"""WITH c AS (SELECT p_partkey AS k, p_brand, p_type, p_size, p_name || ' </b> ' || p_partkey AS t FROM part)
        SELECT k AS p_partkey, 'recipes/parts/' || {_SLUG.format(t='t')} || '-' || substr(k::VARCHAR, 1, 8) || '.html' AS path, replace(replace(t, '<', '&lt;'), '>', '&gt;') AS title, 'head|' || p_brand || '|' || p_type AS parts,
          concat_ws('|', 'Author: A &lt;b&gt;', 'Time: ' || {_HUMAN.format(m='p_size')}, CASE WHEN k % 2 = 0 THEN 'Kept in: Saved' END, 'do ' || p_size, 'then &amp; stop') AS points,
          CASE WHEN k % 5 = 0 THEN 'https://i.example.com/?a=1&amp;b=2' ELSE '' END AS image, k % 2 = 0 OR k % 3 > 0 AS has_card, k % 3 > 0 AS "full" FROM c"""
    feeds = """WITH e AS (SELECT *, CASE event_type WHEN 'click' THEN 0 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS so FROM events WHERE event_type <> 'error'),
        f AS (SELECT 'feeds/' || event_type || '.xml' AS path, *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, so, event_id) AS rank, 50 AS cap FROM e
          UNION ALL SELECT 'feed.xml', *, row_number() OVER (ORDER BY ts DESC, so, event_id), 100 FROM e UNION ALL SELECT 'recipes.xml', *, row_number() OVER (ORDER BY ts DESC, so, event_id), 100 FROM e),
        i AS (SELECT path, rank, 'k' || event_id AS guid, CASE WHEN event_id % 4 > 0 THEN '&lt;T&gt; ' || event_id ELSE 'Untitled recipe' END AS title,
            CASE WHEN event_id % 3 = 0 THEN 'https://o.example.com/' || event_id ELSE 'https://e.example.com/?a=1&amp;b=' || event_id END AS link, CASE WHEN event_id % 5 = 0 THEN 'Saved|' || event_type END AS tags,
            strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' +0000' AS day FROM f WHERE rank <= cap)
        SELECT path, 'https://o.example.com/' || path AS own, string_agg(guid, '|' ORDER BY rank) AS guids, string_agg(title, '|' ORDER BY rank) AS titles, string_agg(link, '|' ORDER BY rank) AS links,
          coalesce(string_agg(tags, '|' ORDER BY rank), '') AS tags, string_agg(day, '|' ORDER BY rank) AS days FROM i GROUP BY path
        UNION ALL SELECT 'cocktails.xml', 'https://o.example.com/cocktails.xml', '', '', '', '', ''"""
    images = """WITH h AS (SELECT p_partkey, ['FFD8FF', '89504E470D0A1A0A', '474946383761', '474946383861', '524946460000000057454250', '424D', '3C68746D6C3E', ''][p_partkey % 8 + 1] || lpad(upper(hex(p_partkey)), 8, '0') AS x,
            CASE WHEN p_partkey % 9 > 0 THEN CASE p_partkey % 8 WHEN 0 THEN 'jpg' WHEN 1 THEN 'png' WHEN 2 THEN 'gif' WHEN 4 THEN 'webp' WHEN 5 THEN 'bmp' END END AS ending FROM part)
        SELECT p_partkey, ending IS NOT NULL AS image_ok, ending, CASE WHEN ending IS NOT NULL THEN to_base64(unhex(x)) END AS base64 FROM h"""
    records = """WITH p AS (SELECT *, p_partkey AS k, p_partkey % 7 = 0 AS micro FROM part WHERE p_partkey % 7 <> 1)
        SELECT k AS p_partkey, p_name AS title,
          CASE WHEN micro THEN p_brand WHEN k % 3 = 0 AND k % 7 = 2 THEN '# Base' || chr(10) || p_brand || chr(10) || '# Top' || chr(10) || p_type || ' & more' WHEN k % 3 = 0 THEN p_brand || chr(10) || p_type || ' & more' ELSE '' END AS ingredients,
          CASE WHEN NOT micro AND k % 5 = 0 THEN 'Start' || chr(10) || 'do ' || p_size ELSE '' END AS instructions,
          CASE WHEN micro THEN NULL WHEN k % 4 = 0 THEN TIMESTAMP '2023-04-05' WHEN k % 4 = 1 THEN TIMESTAMP '2023-05-06 19:30:00' END AS published_at, CASE WHEN micro THEN 60 ELSE p_size END::BIGINT AS cook_minutes,
          CASE WHEN NOT micro AND k % 2 = 1 THEN 'https://i.example.com/' || k || '.jpg' WHEN k % 6 = 1 THEN 'https://o.example.com/x' ELSE 'https://t.example.com/y' END AS image_url
        FROM p WHERE micro OR (k % 13 > 0 AND (k % 3 = 0 OR k % 5 = 0))"""
    return {
        "caption_mixed_parts": _CAPTIONS,
        "caption_first_titles": "SELECT c_custkey, lower(c_mktsegment) || CASE WHEN c_custkey % 6 = 2 THEN ' recipe box' ELSE '' END AS title FROM customer",
        "roster_limits": """WITH n AS (SELECT n_nationkey AS k, lower(n_name) AS name, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey + 1 ELSE 15 END AS cap, b.backfill, b.backfill AND n_nationkey % 6 = 0 AS "all" FROM nation, (VALUES (false), (true)) b(backfill) WHERE n_nationkey % 5 > 0)
            SELECT name, backfill, CASE WHEN k % 2 = 1 THEN 'rehost' ELSE 'link_through' END AS mode, CASE WHEN k % 7 = 0 THEN 'cocktail' ELSE 'recipe' END AS category, (CASE WHEN "all" THEN 300 ELSE cap END)::VARCHAR AS budget,
            (CASE WHEN k % 4 = 2 THEN NULL WHEN "all" AND k % 4 <> 3 THEN 300 ELSE greatest(3 * cap, 30) END)::VARCHAR AS look, CASE WHEN k % 7 = 0 THEN 'The ' || k ELSE 'Nation ' || k END AS title FROM n""",
        "roster_categories": "SELECT DISTINCT 'category:' || CASE WHEN n_nationkey % 7 = 0 THEN 'cocktail' ELSE 'recipe' END AS feed FROM nation WHERE n_nationkey % 5 > 0 UNION ALL SELECT 'all'",
        "display_titles": "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS title FROM part",
        "sitemap_crawl": f"""WITH p AS (SELECT page_id, url, {_HOST} AS source, page_id % 5 AS g FROM pages), d AS (SELECT *, dense_rank() OVER (PARTITION BY source ORDER BY g) AS doc FROM p)
            SELECT source, doc, row_number() OVER (PARTITION BY source, g ORDER BY page_id) - 1 AS pos, url AS loc FROM d WHERE doc <= 3 AND g <> 2""",
        "chef_page_links": """WITH l AS (SELECT p_brand, 0 AS part, p_partkey AS k FROM part WHERE p_partkey % 5 < 2 UNION ALL SELECT p_brand, 1, p_partkey FROM part WHERE p_partkey % 3 = 0 AND length(p_brand) % 2 = 1),
            m AS (SELECT p_brand, k, min({'part': part, 'k': k}) AS place FROM l GROUP BY 1, 2) SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY place) - 1 AS pos, 'https://chef.example.com/recipes/a-' || k AS link FROM m""",
        "seed_repeats": """WITH b AS (SELECT (o_orderkey % 8)::VARCHAR AS source, o_custkey % 97 AS c, o_orderkey AS k, row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) - 1 AS pos FROM orders WHERE o_orderkey % 11 > 0)
            SELECT source, min(pos) AS ord, 'https://www.instagram.com/p/C' || c AS ref, 'said ' || arg_max(k, pos) AS caption FROM b GROUP BY source, c""",
        "saved_listing": "SELECT c_custkey AS ord, 'saved://item/' || c_custkey AS ref, CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2025-01-01 10:00:00' ELSE TIMESTAMP '2024-01-01' + to_days((c_custkey % 300)::INT) END AS date_hint FROM customer WHERE c_custkey < 240",
        "saved_details": """WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 15 = 0 THEN 'D' || o_orderkey WHEN o_orderkey % 2 = 0 THEN 'T' || o_orderkey ELSE '' END AS t, CASE WHEN o_orderkey % 21 = 0 THEN o_orderpriority ELSE '' END AS body FROM orders)
            SELECT k AS o_orderkey, coalesce(nullif(t, ''), body) AS title, body AS text, CASE WHEN k % 9 = 0 THEN 'b' ELSE 'a' END AS tags, 'R' AS author FROM r WHERE t <> '' OR body <> ''""",
        "page_records": records,
        "page_share_images": """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'https://o.example.com/a' WHEN p_partkey % 3 = 2 AND p_partkey % 2 = 0 THEN 'https://t.example.com/b' WHEN p_partkey % 5 = 0 THEN '' ELSE 'https://l.example.com/c' END AS image FROM part""",
        "card_pages": cards,
        "feed_documents": feeds,
        "bundle_archives": """SELECT p_brand AS source, count(*) OVER (PARTITION BY p_brand) AS items, replace(p_name, ' ', '-') || CASE WHEN row_number() OVER w > 1 THEN '-' || row_number() OVER w ELSE '' END || '.json' AS file, p_partkey::VARCHAR AS id
            FROM part WINDOW w AS (PARTITION BY p_brand, p_name ORDER BY p_partkey)""",
        "image_checks": images,
        "fetched_documents": """WITH p AS (SELECT page_id, page_id % 10 = 0 AND page_id % 3 > 0 AS kept, page_id % 7 > 0 AS got, page_id % 2 = 0 AS is_text FROM pages)
            SELECT page_id, CASE WHEN is_text THEN 'text' ELSE 'bytes' END AS kind, CASE WHEN kept THEN 'kept' WHEN got AND is_text THEN 'got ' || page_id || ' ' || chr(65533) END AS body,
            CASE WHEN NOT kept AND got AND NOT is_text THEN hex('got ' || page_id || ' ') || 'FF' END AS bytes, kept OR got AS ok FROM p""",
        "caption_fallbacks": """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'own words' WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN c_name ELSE c_name || ' said' END AS caption,
            CASE WHEN c_custkey % 7 = 0 THEN 'own.jpg' WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN 'https://i.example.com/j' ELSE 'https://i.example.com/m' END AS image_url FROM customer""",
        "catalog_document": f"SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS seq, p_partkey, p_name || ' </b> ' || p_partkey AS title, p_type || ';a,b' AS tags, {_ISO.format(m='p_size')} AS total_time, false AS in_feed FROM part",
        "catalog_lookups": """SELECT 'source' AS part, o_orderkey FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'category', o_orderkey FROM orders WHERE o_custkey % 2 = 1 UNION ALL SELECT 'every', o_orderkey FROM orders
            UNION ALL SELECT 'known', o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)""",
        "iso_texts": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS said, date_trunc('second', ts) AS back FROM events",
        "free_dates": f"SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('day', ts)::TIMESTAMP WHEN 1 THEN {minute} WHEN 3 THEN {minute} - INTERVAL 2 HOUR END AS parsed FROM events",
        "build_counts": f"""WITH {_RUNS}, s AS (SELECT source, any_value(cap) AS cap, count(*) AS shown FROM w GROUP BY source UNION ALL SELECT 'none', 40, 0),
            r AS (SELECT s.*, run, greatest(shown - run * cap, 0) AS new FROM s, (VALUES (0), (1), (2)) v(run) WHERE run < 2 OR source = 'posts'),
            d AS (SELECT r.*, (SELECT count(*) FROM a WHERE a.source = r.source AND a.run = r.run AND ok) AS added FROM r), t AS (SELECT run, sum(sum(added)) OVER (ORDER BY run) AS total FROM d GROUP BY run)
            SELECT run::BIGINT AS run, source, shown AS discovered, new, least(new, cap) AS processing, added, total::BIGINT AS total FROM d JOIN t USING (run)""",
        "build_catalog": f"""WITH {_RUNS} SELECT a.source, item, coalesce(p_name, c_name, s_name) AS title, CASE WHEN a.source IN ('posts', 'kept') THEN 'rehost' ELSE 'link_through' END AS mode, CASE WHEN a.source = 'listed' THEN 'cocktail' ELSE 'recipe' END AS category,
            CASE WHEN a.source = 'posts' THEN 'Poster' ELSE '' END AS author, CASE WHEN a.source = 'fed' THEN TIMESTAMP '2024-01-02 10:00:00' WHEN a.source = 'kept' THEN TIMESTAMP '2024-01-05' WHEN a.source = 'web' AND item % 3 = 0 THEN TIMESTAMP '2023-05-06' WHEN a.source = 'web' AND item % 4 > 0 THEN TIMESTAMP '2024-01-01' + to_days((item % 28)::INT) END AS published_at,
            a.source = 'posts' AS hosted, a.source = 'posts' AND item % 2 = 0 AS has_image, true AS image_agrees, CASE WHEN a.source = 'kept' THEN '' WHEN a.source <> 'posts' THEN 'x' WHEN item % 3 = 0 THEN 'salt' ELSE '' END AS ingredients
            FROM a LEFT JOIN part ON a.source = 'web' AND p_partkey = item LEFT JOIN customer ON a.source = 'posts' AND c_custkey = item LEFT JOIN supplier ON a.source IN ('fed', 'listed', 'kept') AND s_suppkey = item WHERE ok""",
        "build_resumed": """WITH c AS (SELECT 'nation-' || c_nationkey AS source, c_custkey AS k, c_custkey % 11 <> 5 AS ok FROM customer),
            x AS (SELECT source, unnest(['pages', 'items']) AS kind FROM c WHERE ok UNION ALL SELECT source, 'images' FROM c WHERE ok AND k % 2 = 0
            UNION ALL SELECT source, 'failures' FROM c WHERE NOT ok UNION ALL SELECT DISTINCT source, 'feeds' FROM c WHERE ok) SELECT source, kind, count(*) AS n FROM x GROUP BY ALL""",
        "build_files": f"""WITH {_RUNS}, g AS (SELECT * FROM a WHERE ok) SELECT 'pages' AS kind, count(*) AS files FROM g WHERE source IN ('posts', 'kept') UNION ALL SELECT 'images', count(*) FROM g WHERE source = 'posts' AND item % 2 = 0
            UNION ALL SELECT DISTINCT 'feeds/' || source || '.xml', 1 FROM g UNION ALL SELECT DISTINCT 'bundles/' || source || '.zip', 1 FROM g UNION ALL SELECT unnest(['feed.xml', 'recipes.xml', 'cocktails.xml', 'index.html']), 1""",
    }
