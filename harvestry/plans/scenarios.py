"""More queries over the test tables: whole flows (a build in three runs, files written and read again) and
operators whose input is made of several rules, each with SQL that says from the rows what must come out."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable
from datetime import datetime

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions import dates, text
from harvestry.operators import captions, ranking, state
from harvestry.plans import build
from harvestry.plans.queries import _cards, _ntz, _t, _ts
from harvestry.scratch import materialise, new_folder
from harvestry.sinks import render, store, tables
from harvestry.sources import fetch, pages, roster, saved_items, seeds, xml_feeds
from harvestry.sources.schemas import CATALOG, DOCUMENTS, FAILURES, conform

NOW = datetime(2024, 2, 1)


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _cat(*parts) -> F.Column:
    """Texts and columns after each other; a plain str is a text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _in_order(rows: DataFrame, group: list[str], order: list[str], line: F.Column, mark: str = "\n") -> DataFrame:
    """Each group's lines, in order, as one text named text."""
    one = rows.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct(*order, line.alias("the_line")))).alias("xs"))
    return one.select(*group, F.array_join(F.transform("xs", lambda x: x["the_line"]), mark).alias("text"))


# -- captions of many shapes ------------------------------------------------------------------------

#: Lines of captions; # stands for a number of the row.
POOL = (
    "Ingredients:", "For the sauce:", "METHOD", "Macros", "you'll need", "Directions :", "Nutrition", "per serving:",
    "- #g sugar", "• # onions", "#) stir and wait", "Step #: fold in", "1.", "Serves #", "makes # small loaves for later on", "Yield: #",
    "#0 kcal | #g protein", "about #g carbs in all of it", "#food #home", "for the best results, wait", "a line of prose #", "   ", "***", "⁠Plain words #  ",
)


def _mixed(spark, d):
    """A caption for each part that was sold: a line of POOL for each sale, by the numbers of the sale."""
    li = _t(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").cast("int").alias("q")).distinct()
    which = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_suppkey") + F.col("q")) % len(POOL)
    line = F.replace(F.get(F.array(*map(F.lit, POOL)), which.cast("int")), F.lit("#"), F.when(which != POOL.index("#food #home"), _s("q")).otherwise("#"))
    made = _in_order(li, ["l_partkey"], ["l_orderkey", "l_linenumber", "l_suppkey", "q"], line)
    return made.select("l_partkey", captions.parse_caption(_cat("Part ", F.col("l_partkey"), " \U0001f372 recipe below\n", F.col("text"))).alias("p"))


def caption_mixed_parts(spark, d):
    p = _mixed(spark, d)
    joined = lambda c: F.array_join(c, "\n")
    return p.select("l_partkey", "p.title", F.sha1(F.col("p.description").cast("binary")).alias("description"), joined("p.ingredients").alias("ingredients"), joined("p.instructions").alias("instructions"), "p.nutrition", "p.servings", "p.confident")


def caption_first_titles(spark, d):
    c = _t(spark, d, "customer")
    heads = ("#a #b", "***", "Ingredients", "  ", "✨ .", "")
    head = F.array_join(F.transform(F.sequence(F.lit(0), (F.col("c_custkey") % 7).cast("int")), lambda i: F.get(F.array(*map(F.lit, heads)), ((F.col("c_custkey") + i) % len(heads)).cast("int"))), "\n")
    tail = F.get(F.array(*map(F.lit, (" recipe in my bio", " - recipe down below!", " recipe box", "!..", "", "|"))), (F.col("c_custkey") % 6).cast("int"))
    return c.select("c_custkey", captions.parse_caption(F.concat(head, F.lit("\n⭐ "), F.lower("c_mktsegment"), tail, F.lit("\nmore"))).getField("title").alias("title"))


# -- roster, crawls, lists --------------------------------------------------------------------------


def _nation_roster(spark, d) -> str:
    """A roster in YAML of the nations, 25 rows."""
    kinds = ("sitemap", "native_feed", "seed_list", "saved_items")
    rows = []
    for r in _t(spark, d, "nation").orderBy("n_nationkey").collect():
        k = r["n_nationkey"]
        own = {"name": r["n_name"].lower(), "discovery": kinds[k % 4], "mode": "rehost" if k % 2 else "link_through"}
        if k % 3 == 0:
            own["max_new_per_run"] = k + 1
        if k % 5 == 0:
            own["enabled"] = False
        if k % 6 == 0:
            own["backfill_limit"] = 300
        if k % 7 == 0:
            own |= {"category": "cocktail", "display_name": f"The {k}"}
        rows.append(own)
    return yaml.safe_dump({"defaults": {"max_new_per_run": 15}, "sources": rows})


def roster_limits(spark, d):
    on = roster.enabled(roster.roster_table(spark, roster.parse_roster(_nation_roster(spark, d))))
    both = [roster.with_limits(on, full).withColumn("backfill", F.lit(full)) for full in (False, True)]
    return both[0].unionByName(both[1]).select("name", "backfill", "mode", "category", _s("budget").alias("budget"), _s("window").alias("look"), text.display_title(F.col("name"), F.col("display_name")).alias("title"))


def roster_categories(spark, d):
    on = roster.roster_table(spark, roster.parse_roster(_nation_roster(spark, d)))
    return ranking.feed_roster(on)


def display_titles(spark, d):
    p = _t(spark, d, "part")
    name = F.translate("p_name", " ", "-")
    name = F.when(F.col("p_partkey") % 2 == 0, F.translate("p_name", " ", "_")).otherwise(name)
    return p.select("p_partkey", text.display_title(name, F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).when(F.col("p_partkey") % 3 == 1, "")).alias("title"))


def sitemap_crawl(spark, d):
    """A map of maps for each host: five maps, the third newest of which can't be had, and three may be read."""
    p = _t(spark, d, "pages").select("page_id", "url", F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host"), (F.col("page_id") % 5).alias("g"))
    nested = p.select("host", "g").distinct()
    root = _in_order(nested, ["host"], ["g"], _cat("<sitemap><loc>https://", F.col("host"), "/m", F.col("g"), ".xml</loc><lastmod>2024-01-0", F.lit(9) - F.col("g"), "</lastmod></sitemap>"))
    maps = _in_order(p.filter("g <> 2"), ["host", "g"], ["page_id"], _cat("<url><loc>", text.xml_escape(F.col("url")), "</loc></url>"))
    docs = root.select(_cat("https://", F.col("host"), "/root.xml").alias("url"), _cat("<sitemapindex>", F.col("text"), "</sitemapindex>").alias("body"))
    docs = docs.unionByName(maps.select(_cat("https://", F.col("host"), "/m", F.col("g"), ".xml").alias("url"), _cat("<urlset>", F.col("text"), "</urlset>").alias("body")))
    roots = root.select(F.col("host").alias("source"), _cat("https://", F.col("host"), "/root.xml").alias("sitemap"))
    have = docs.select("url", F.lit("text").alias("kind"), "body", F.lit(None).cast("binary").alias("bytes"), F.lit(True).alias("ok"))
    found = xml_feeds.crawl_sitemaps(spark, roots, have, max_nested=3)
    return found.select("source", F.col("doc").cast("bigint").alias("doc"), F.col("pos").cast("bigint").alias("pos"), "loc")


def chef_page_links(spark, d):
    p = _t(spark, d, "part").select("p_brand", "p_partkey")
    name = _cat("a-", F.col("p_partkey"))
    kinds = [_cat('<a href="/recipes/', name, '/?x=1">x</a>'), _cat("<a class='z' href='/recipes/", name, "'>y</a>"), _cat('<a href="/about/', name, '">no</a>'), _cat('<a href="/recipes/', name, '/more">no</a>'), F.lit("")]
    anchors = _in_order(p, ["p_brand"], ["p_partkey"], F.get(F.array(*kinds), (F.col("p_partkey") % 5).cast("int")))
    data = _in_order(p.filter("p_partkey % 3 = 0"), ["p_brand"], ["p_partkey"], _cat('"/recipes/', name, '"'), ",").withColumnsRenamed({"p_brand": "b", "text": "data"})
    bad = F.when(F.length("p_brand") % 2 == 0, F.lit("")).otherwise(F.lit("]"))  # a broken list holds nothing
    html = _cat(F.col("text"), '<script id="__NEXT_DATA__" type="application/json">[', F.coalesce("data", F.lit("")), bad, "</script>")
    met = anchors.join(data, F.col("p_brand") == F.col("b"), "left").select("p_brand", html.alias("html"))
    return met.select("p_brand", F.posexplode(pages.chef_links(F.col("html"), F.lit("https://chef.example.com/all"))).alias("pos", "link")).withColumn("pos", F.col("pos").cast("bigint"))


def seed_repeats(spark, d):
    """Lists in which posts come again in other spellings, beside blocks that name no post."""
    o = _t(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 8).alias("k"), (F.col("o_custkey") % 97).alias("c"))
    spelled = F.when(F.col("o_orderkey") % 3 == 0, "?utm_source=z").when(F.col("o_orderkey") % 3 == 1, "/").otherwise("")
    block = F.when(F.col("o_orderkey") % 11 == 0, _cat("just words ", F.col("o_orderkey"))).otherwise(_cat("https://www.instagram.com/p/C", F.col("c"), spelled, "\nsaid ", F.col("o_orderkey")))
    lists = _in_order(o, ["k"], ["o_orderkey"], block, "\n===\n")
    out = seeds.seed_entries(lists.select(_s("k").alias("source"), "text"))
    # places count the blocks that name a post
    return out.select("source", "ord", "ref", "caption")


def saved_listing(spark, d):
    """Pages of 50 of a listing in files, of which each shows the last item of the page before again."""
    c = _t(spark, d, "customer").select("c_custkey", F.floor(F.col("c_custkey") / 50).alias("page"))
    again = c.filter("c_custkey % 50 = 49").select("c_custkey", (F.col("page") + 1).alias("page"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int")), "yyyy-MM-dd")
    item = _cat('{"id":"', F.col("c_custkey"), '","created_at":"', day, F.when(F.col("c_custkey") % 2 == 0, '","enriched_at":"2025-01-01T10:00:00Z"}').otherwise('"}'))
    rows = _in_order(c.unionByName(again), ["page"], ["c_custkey"], item, ",")
    name = F.when(F.col("page") == 0, "first.json").otherwise(_cat("c", F.col("page"), ".json"))
    folder = new_folder(spark, "saved")
    render.write_files(rows.select(name.alias("path"), _cat('{"items":[', F.col("text"), '],"next_cursor":"c', F.col("page") + 1, '"}').alias("body")), folder)
    listed = saved_items.listing(spark, folder, 240).select(F.lit("s").alias("source"), "ord", "i")
    return saved_items.saved_refs(listed).select("ord", "ref", _ntz(F.col("date_hint")).alias("date_hint"))


def saved_details(spark, d):
    """Items and, for some, details: what a detail doesn't say the item says, and what neither says is no record."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    k = F.col("o_orderkey")
    item = F.from_json(_cat('{"id":"', k, '","title":"', F.when(k % 2 == 0, _cat("T", k)).otherwise(""), '","summary":"', F.when(k % 6 == 0, "short").otherwise(""), '","tags":["a"]}'), saved_items.ITEM)
    said = F.from_json(_cat('{"id":"', k, '","title":"', F.when(k % 5 == 0, _cat(" D", k, " ")).otherwise(""), '","content_md":"', F.when(k % 7 == 0, F.col("o_orderpriority")).otherwise(""), '","tags":[', F.when(k % 9 == 0, '"b"').otherwise(""), "]}"), saved_items.ITEM)
    rows = o.select(F.lit("s").alias("source"), F.lit("rehost").alias("mode"), F.lit("recipe").alias("category"), F.lit("R").alias("rehost_author"), item.alias("i"), F.when(k % 3 == 0, said).alias("detail"))
    out = saved_items.saved_records(rows)
    return out.select(F.regexp_extract("ref", "([0-9]+)$", 1).cast("bigint").alias("o_orderkey"), "title", "text", F.array_join("categories", ";").alias("tags"), "author")


# -- pages ------------------------------------------------------------------------------------------


def _record_pages(spark, d):
    """Pages of parts: JSON-LD, microdata, groups of ingredients, broken blocks, missing titles and parts."""
    p = _t(spark, d, "part")
    k = F.col("p_partkey")
    day = F.when(k % 4 == 0, '"datePublished":"2023-04-05",').when(k % 4 == 1, '"datePublished":"","dateModified":"May 6th, 2023 7:30 PM",').when(k % 4 == 2, '"dateModified":"sometime in May",').otherwise("")
    title = F.when(k % 13 == 0, " ").otherwise(F.col("p_name"))
    items = F.when(k % 3 == 0, _cat('"recipeIngredient":["', F.col("p_brand"), '","', F.col("p_type"), ' &amp; more"],')).otherwise("")
    steps = F.when(k % 5 == 0, _cat('"recipeInstructions":[{"@type":"HowToSection","name":"Start","itemListElement":[{"@type":"HowToStep","text":"do ', F.col("p_size"), '"}]}],')).otherwise("")
    picture = F.when(k % 2 == 0, '"image":"data:image/gif;base64,AA",').otherwise(_cat('"image":["https://i.example.com/', k, '.jpg"],'))
    ld = _cat('<script type="application/ld+json">{"@context":"https://schema.org","@graph":[{"@type":"WebPage"},{"@type":["Thing","Recipe"],"name":"', title, '",', day, items, steps, picture, '"cookTime":"PT', F.col("p_size"), 'M"}]}</script>')
    groups = _cat('<div class="w-ingredient-group"><h4>Base:</h4><ul><li>x</li></ul></div><div class="w-ingredient-group"><h4>Top</h4><ul><li>y</li></ul></div>')
    micro = _cat('<div itemscope itemtype="http://schema.org/Recipe"><h1 itemprop="name">', F.col("p_name"), '</h1><li itemprop="recipeIngredient">', F.col("p_brand"), '</li><time itemprop="cookTime" datetime="PT1H">1 h</time></div>')
    head = F.when(k % 6 == 1, '<meta property="og:image" content="https://o.example.com/x">').otherwise('<meta name="twitter:image" content="https://t.example.com/y">')
    body = F.when(k % 7 == 0, _cat('<script type="application/ld+json">{"@type":"Recipe",</script>', micro)).when(k % 7 == 1, "<p>no record</p>").when(k % 7 == 2, _cat(ld, groups)).otherwise(ld)
    return p.select("p_partkey", _cat("<html><head>", head, "</head><body>", body, '<img src="data:x" data-src=" https://l.example.com/z "></body></html>').alias("html"))


def page_records(spark, d):
    rows = _record_pages(spark, d).select(F.lit("s").alias("source"), _cat("https://e.example.com/p/", F.col("p_partkey")).alias("ref"), "html", F.lit("rehost").alias("mode"), F.lit("recipe").alias("category"), F.lit("").alias("rehost_author"))
    out = pages.extract_records(rows)
    return out.select(F.regexp_extract("ref", "([0-9]+)$", 1).cast("bigint").alias("p_partkey"), "title", "ingredients", "instructions", _ntz(F.col("published_at")).alias("published_at"), F.col("cook_minutes").cast("bigint").alias("cook_minutes"), "image_url")


def page_share_images(spark, d):
    p = _t(spark, d, "part").select("p_partkey")
    k = F.col("p_partkey")
    og = F.when(k % 3 == 0, '<meta property="og:image" content=" https://o.example.com/a ">').when(k % 3 == 1, '<meta property="og:image" content="data:no">').otherwise("")
    twitter = F.when(k % 2 == 0, '<meta name="twitter:image" content="https://t.example.com/b">').otherwise("")
    images = F.when(k % 5 == 0, "<img alt='none'>").otherwise('<img src="data:lazy" data-lazy-src="https://l.example.com/c">')
    return p.select("p_partkey", pages.page_image(_cat("<head>", og, twitter, "</head>", images)).alias("image"))


def card_pages(spark, d):
    """What a reader and a program see on the page of each part, taken out of the page again."""
    from harvestry.operators.cards import emit_decision

    c = _cards(spark, d).withColumns({"confident": F.col("seq") % 3 > 0, "has_confidence": F.lit(True), "author": F.lit("A <b>"), "image_url": F.when(F.col("seq") % 5 == 0, "https://i.example.com/?a=1&b=2").otherwise("")})
    made = render.item_pages(emit_decision(c))
    every = lambda pattern: F.array_join(F.regexp_extract_all("body", F.lit(pattern), F.lit(1)), "|")
    return made.select(
        F.col("dedup_key").cast("bigint").alias("p_partkey"), "path", every("<h1>(.*?)</h1>").alias("title"), every("<d[dt]>(.*?)</d[dt]>").alias("parts"), every("<li>(.*?)</li>").alias("points"),
        every('<meta property="og:image" content="(.*?)"').alias("image"), F.contains("body", F.lit("application/ld+json")).alias("has_card"), F.contains("body", F.lit('"recipeIngredient":')).alias("full"),
    )


# -- feeds, bundles, images, catalog ------------------------------------------------------------------


def feed_documents(spark, d):
    """The feeds of the events' catalog as XML, and what a reader takes out of them."""
    e = _t(spark, d, "events")
    catalog = e.select(
        F.col("event_id").alias("seq"), _cat("k", F.col("event_id")).alias("dedup_key"), F.col("event_type").alias("source"), _cat("https://e.example.com/?a=1&b=", F.col("event_id")).alias("source_url"), F.lit("rehost").alias("mode"),
        F.when(F.col("event_id") % 4 > 0, _cat("<T> ", F.col("event_id"))).otherwise("").alias("title"), F.when(F.col("event_id") % 3 == 0, _cat("https://o.example.com/", F.col("event_id"))).otherwise("").alias("page_url"),
        F.when(F.col("event_id") % 2 == 0, _ts("ts")).alias("published_at"), _ts("ts").alias("discovered_at"), F.when(F.col("event_id") % 5 == 0, "Saved").otherwise("").alias("saved_via"), F.array("event_type").alias("categories"),
    )
    names = [("click", "recipe"), ("error", "cocktail"), ("purchase", "recipe"), ("signup", "recipe"), ("view", "recipe")]
    sources = spark.createDataFrame([(i, n, c, n != "error") for i, (n, c) in enumerate(names)] + [(9, "empty", "cocktail", True)], "ord int, name string, category string, enabled boolean")
    made = render.rss_feeds(ranking.feeds(conform(catalog), sources), ranking.feed_roster(sources), "https://o.example.com", NOW)
    every = lambda pattern, mark="|": F.array_join(F.regexp_extract_all("body", F.lit(pattern), F.lit(1)), mark)
    return made.select(
        "path", every('<atom:link href="(.*?)" rel="self"').alias("own"), every("<guid isPermaLink=\"false\">(.*?)</guid>").alias("guids"), every("<item><title>(.*?)</title>").alias("titles"),
        every("</title><link>(https://[eo].example.com/[?0-9].*?)</link>").alias("links"), every("<category>(.*?)</category>").alias("tags"), every("<pubDate>(.*?)</pubDate>").alias("days"),
    )


def bundle_archives(spark, d):
    """The files in the archive of each brand that has any, read out of the archive again."""
    c = _cards(spark, d)
    p = _t(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_brand", "p_name")
    rows = c.drop("source", "title").join(p, F.col("seq") == F.col("k")).withColumns({"source": F.col("p_brand"), "title": F.col("p_name")})
    folder = new_folder(spark, "bundles")
    made = render.write_bundles(render.bundles(rows.select(*CATALOG.names)), folder)
    whole = spark.read.format("binaryFile").load(folder).select(F.url_decode(F.regexp_extract("path", r"([^/]+)\.zip$", 1)).alias("s"), "content")

    def unpack(frames):
        for frame in frames:
            for source, items, content in frame[["source", "items", "content"]].itertuples(index=False):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    yield pd.DataFrame([(source, items, n, json.loads(z.read(n))["id"]) for n in z.namelist()], columns=["source", "items", "file", "id"])

    return made.join(whole, F.col("source") == F.col("s")).select("source", "items", "content").mapInPandas(unpack, "source string, items long, file string, id string")


def image_checks(spark, d):
    p = _t(spark, d, "part").select("p_partkey")
    heads = ("FFD8FF", "89504E470D0A1A0A", "474946383761", "474946383861", "524946460000000057454250", "424D", "3C68746D6C3E", "")
    raw = F.unhex(_cat(F.get(F.array(*map(F.lit, heads)), (F.col("p_partkey") % len(heads)).cast("int")), F.lpad(F.hex("p_partkey"), 8, "0")))
    docs = p.select(_s("p_partkey").alias("url"), F.lit("bytes").alias("kind"), F.lit(None).cast("string").alias("body"), raw.alias("bytes"), (F.col("p_partkey") % 9 > 0).alias("ok"))
    out = fetch.hosted_images(docs)
    return out.select(F.col("url").cast("bigint").alias("p_partkey"), "image_ok", "ending", "base64")


def fetched_documents(spark, d):
    """Addresses that a table has, that can be got, and that can't."""
    p = _t(spark, d, "pages").select("page_id", "url")
    wanted = p.select(F.col("page_id").cast("string").alias("url"), F.when(F.col("page_id") % 2 == 0, "text").otherwise("bytes").alias("kind"))
    cache = p.filter("page_id % 5 = 0").select(F.col("page_id").cast("string").alias("url"), F.lit("text").alias("kind"), F.lit("kept").alias("body"), F.lit(None).cast("binary").alias("bytes"), (F.col("page_id") % 3 > 0).alias("ok"))

    def get(url: str) -> bytes:
        if int(url) % 7 == 0:
            raise OSError(url)
        return b"got " + url.encode() + b" \xff"

    out = fetch.fetch(wanted, cache, get, delay=0, tries=1)
    return out.select(F.col("url").cast("bigint").alias("page_id"), "kind", F.col("body").alias("body"), F.hex("bytes").alias("bytes"), "ok")


def caption_fallbacks(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    k = F.col("c_custkey")
    body = F.when(k % 3 == 0, _cat('{"title":"', F.col("c_name"), '","thumbnail_url":"https://i.example.com/j"}')).otherwise(_cat('<meta property="og:description" content="', F.col("c_name"), ' said"><meta property="og:image" content="https://i.example.com/m">'))
    docs = c.select(_s(k).alias("url"), F.lit("text").alias("kind"), body.alias("body"), F.lit(None).cast("binary").alias("bytes"), (k % 4 > 0).alias("ok"))
    rows = c.select(_s(k).alias("url"), F.when(k % 5 == 0, "own words").otherwise("").alias("caption"), F.when(k % 7 == 0, "own.jpg").otherwise("").alias("image_url"))
    return fetch.caption_fallback(rows, docs).select(F.col("url").cast("bigint").alias("c_custkey"), "caption", "image_url")


def catalog_document(spark, d):
    """A stored catalog as one JSON document, read back."""
    made = _cards(spark, d)
    stored = tables.Snapshots(spark, new_folder(spark, "catalog"), CATALOG, ("source",))
    old = stored.write(made.withColumn("title", F.lit("old")))
    now = stored.write(old.drop("title").join(made.select(F.col("seq").alias("s"), "title"), F.col("seq") == F.col("s")))
    path = f"{new_folder(spark, 'document')}/catalog.json"
    tables.write_document(tables.catalog_lines(now, spark.createDataFrame([], FAILURES), NOW), path)
    back = tables.import_json(spark, path)
    return back.select("seq", F.col("dedup_key").cast("bigint").alias("p_partkey"), "title", F.array_join("categories", ";").alias("tags"), "total_time", "in_feed")


def catalog_lookups(spark, d):
    """Catalog rows of a source, of a category, and of wanted keys."""
    c = conform(_t(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), _s("o_orderkey").alias("dedup_key"), F.col("o_orderstatus").alias("source"), F.lit("").alias("source_url"), F.lit("rehost").alias("mode"), F.when(F.col("o_custkey") % 2 == 0, "recipe").otherwise("cocktail").alias("category")))
    keys = _t(spark, d, "lineitem").filter("l_quantity > 45").select(_s("l_orderkey").alias("k"))
    parts = {"source": ranking.of_source(c, "O"), "category": ranking.of_category(c, "cocktail"), "every": ranking.of_category(c), "known": state.known(c, keys.select(F.col("k").alias("dedup_key")))}
    out = None
    for name, rows in parts.items():
        one = rows.select(F.lit(name).alias("part"), F.col("seq").alias("o_orderkey"))
        out = one if out is None else out.unionByName(one)
    return out


def iso_texts(spark, d):
    e = _t(spark, d, "events").select("event_id", _ts("ts").alias("ts"))
    said = dates.iso_text(F.col("ts"))
    return e.select("event_id", said.alias("said"), _ntz(dates.parse_date(said)).alias("back"))


def free_dates(spark, d):
    e = _t(spark, d, "events").select("event_id", _ts("ts").alias("ts"))
    forms = [_cat("on ", F.date_format("ts", "d"), "th of ", F.date_format("ts", "MMMM yyyy")), _cat(F.date_format("ts", "MMMM"), " ", F.date_format("ts", "d"), ", ", F.date_format("ts", "yyyy"), " at ", F.date_format("ts", "h:mm a")), F.date_format("ts", "MMMM yyyy"), _cat(F.date_format("ts", "dd.MMM.yyyy HH:mm"), " +02:00"), F.lit("soon")]
    said = F.get(F.array(*forms), (F.col("event_id") % len(forms)).cast("int"))
    return e.select("event_id", _ntz(dates.parse_any_date(said)).alias("parsed"))


# -- a build in three runs --------------------------------------------------------------------------

ROSTER = """
defaults: {max_new_per_run: 40}
sources:
- {name: web, mode: link_through, discovery: sitemap, sitemap: "https://w.example.com/map.xml", url_pattern: "/p/"}
- {name: posts, mode: rehost, discovery: seed_list, rehost_author: Poster}
- {name: fed, mode: link_through, discovery: native_feed, feed_url: "https://f.example.com/feed", max_new_per_run: 5}
- {name: listed, mode: link_through, discovery: index_page, url: "https://l.example.com/all", category: cocktail}
- {name: kept, mode: rehost, discovery: saved_items, max_new_per_run: 7}
- {name: "none", mode: rehost, discovery: seed_list}
- {name: "off", mode: rehost, discovery: seed_list, enabled: false}
"""


def _build_inputs(spark, d) -> build.Inputs:
    part, customer, supplier = (_t(spark, d, n) for n in ("part", "customer", "supplier"))
    k = F.col("p_partkey")
    url = _cat("https://w.example.com/p/", k)
    day = _cat("2024-01-", F.lpad(_s(k % 28 + 1), 2, "0"))
    places = _in_order(part.withColumn("one", F.lit(1)), ["one"], ["p_partkey"], _cat("<url><loc>", F.when(k % 10 == 9, _cat("https://w.example.com/about/", k)).otherwise(url), "</loc>", F.when(k % 4 > 0, _cat("<lastmod>", day, "</lastmod>")).otherwise(""), "</url>"))
    ld = lambda name, more: _cat('<script type="application/ld+json">{"@type":"Recipe","name":"', name, '"', more, ',"recipeIngredient":["x"]}</script>')
    page = F.when(k % 7 == 0, "<p>nothing here</p>").otherwise(ld(F.col("p_name"), F.when(k % 3 == 0, ',"datePublished":"2023-05-06"').otherwise("")))
    items = _in_order(supplier.withColumn("one", F.lit(1)), ["one"], ["s_suppkey"], _cat("<item><link>https://f.example.com/i/", F.col("s_suppkey"), "</link><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item>"), "")
    links = _in_order(supplier.withColumn("one", F.lit(1)), ["one"], ["s_suppkey"], _cat('<a href="/i/', F.col("s_suppkey"), '">x</a>'), "")
    texts = [
        places.select(F.lit("https://w.example.com/map.xml").alias("url"), _cat("<urlset>", F.col("text"), "</urlset>").alias("body")),
        part.select(url.alias("url"), page.alias("body")),
        items.select(F.lit("https://f.example.com/feed").alias("url"), _cat("<rss><channel>", F.col("text"), "</channel></rss>").alias("body")),
        supplier.select(_cat("https://f.example.com/i/", F.col("s_suppkey")).alias("url"), ld(F.col("s_name"), F.lit("")).alias("body")),
        links.select(F.lit("https://l.example.com/all").alias("url"), F.col("text").alias("body")),
        supplier.select(_cat("https://l.example.com/i/", F.col("s_suppkey")).alias("url"), ld(F.col("s_name"), F.lit("")).alias("body")),
    ]
    docs = None
    for rows in texts:
        docs = rows if docs is None else docs.unionByName(rows)
    docs = docs.select("url", F.lit("text").alias("kind"), "body", F.lit(None).cast("binary").alias("bytes"), F.lit(True).alias("ok"))
    pictures = customer.select(_cat("https://i.example.com/", F.col("c_custkey")).alias("url"), F.lit("bytes").alias("kind"), F.lit(None).cast("string").alias("body"), F.unhex(F.when(F.col("c_custkey") % 2 == 0, "FFD8FF00").otherwise("3C68746D")).alias("bytes"), F.lit(True).alias("ok"))
    c = F.col("c_custkey")
    block = _cat("https://www.instagram.com/p/C", c, "/\nimage: https://i.example.com/", c, "\n\n", F.col("c_name"), F.when(c % 3 == 0, "\nIngredients\n- salt\nMethod\n1. stir").otherwise("\nonly words"))
    block = F.when(c % 11 == 5, _cat("https://www.instagram.com/p/C", c, "/")).otherwise(block)  # says nothing: a failure
    lists = _in_order(customer.withColumn("one", F.lit(1)), ["one"], ["c_custkey"], block, "\n===\n").select(F.lit("posts").alias("source"), "text")
    s = F.col("s_suppkey")
    saved = supplier.select(F.lit("kept").alias("source"), s.alias("ord"), F.from_json(_cat('{"id":"', s, '","title":"', F.when(s % 5 > 0, F.col("s_name")).otherwise(""), '","created_at":"2024-01-05"}'), saved_items.ITEM).alias("i"))
    # what was fetched is a table by the time a build runs
    return build.Inputs(materialise(docs.unionByName(pictures).select(*DOCUMENTS.names), "documents"), materialise(lists, "lists"), saved)


def _three_runs(spark, d) -> tuple[list[dict], DataFrame, str]:
    """What three runs at one time return, the last of one source only, and the catalog and files after them."""
    sources, inputs = roster.roster_table(spark, roster.parse_roster(ROSTER)), _build_inputs(spark, d)
    folder, docs = new_folder(spark, "state"), new_folder(spark, "docs")
    found = [build.run(spark, sources, inputs, folder, docs, "https://o.example.com", NOW, make_bundles=i == 2, only=["posts"] if i == 2 else None) for i in range(3)]
    return found, store.Store(spark, folder).read("catalog"), docs


def build_counts(spark, d):
    found, _, _ = _three_runs(spark, d)
    rows = [(i, s, *(n[x] for x in ("discovered", "new", "processing", "added")), found[i]["total"]) for i, r in enumerate(found) for s, n in r["sources"].items()]
    return spark.createDataFrame(rows, "run long, source string, discovered long, new long, processing long, added long, total long")


def build_catalog(spark, d):
    _, catalog, _ = _three_runs(spark, d)
    number = F.coalesce(F.nullif(F.regexp_extract("source_url", "([0-9]+)$", 1), F.lit("")), F.regexp_extract("title", "([0-9]+)$", 1), F.lit("")).try_cast("bigint")
    item = F.when(F.col("source") == "posts", F.regexp_extract("source_url", "/C([0-9]+)", 1).cast("bigint")).otherwise(number)
    return catalog.select(
        "source", item.alias("item"), "title", "mode", "category", "author", _ntz(F.col("published_at")).alias("published_at"), F.startswith("page_url", F.lit("https://o.example.com/recipes/posts/")).alias("hosted"),
        (F.col("local_image") != "").alias("has_image"), (F.col("image_url") == F.when(F.col("local_image") == "", "").otherwise(_cat("https://o.example.com/", F.col("local_image")))).alias("image_agrees"), "ingredients",
    )


def build_files(spark, d):
    """The files that three runs leave: feeds, index, pages, images and bundles, by folder."""
    _, _, docs = _three_runs(spark, d)
    files = render.listed(spark, docs).select("file")
    kind = F.when(F.contains("file", F.lit("/img/")), "images").when(F.startswith("file", F.lit("recipes/")), "pages").otherwise(F.col("file"))
    return files.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("files"))


class _Stopped(Exception):
    pass


def build_resumed(spark, d):
    """What a build of a seed list a nation leaves that was stopped three times: before its commit, before its first file, and before its feeds."""
    nations = [r[0] for r in _t(spark, d, "nation").select("n_nationkey").orderBy("n_nationkey").collect()]  # the roster
    text = "defaults: {mode: rehost, discovery: seed_list, max_new_per_run: 1000000}\nsources:\n" + "".join(f"- {{name: nation-{n}}}\n" for n in nations)
    c = F.col("c_custkey")
    block = _cat("https://www.instagram.com/p/C", c, "/\nimage: https://i.example.com/", c, "\n\n", F.when(c % 11 != 5, _cat(F.col("c_name"), "\nIngredients\n- salt\nMethod\n1. stir")).otherwise(""))
    customer = _t(spark, d, "customer")
    lists = _in_order(customer.withColumn("source", _cat("nation-", F.col("c_nationkey"))), ["source"], ["c_custkey"], block, "\n===\n")
    pictures = customer.select(_cat("https://i.example.com/", c).alias("url"), F.lit("bytes").alias("kind"), F.lit(None).cast("string").alias("body"), F.unhex(F.when(c % 2 == 0, "FFD8FF00").otherwise("3C68746D")).alias("bytes"), F.lit(True).alias("ok"))
    pictures, lists = materialise(pictures, "documents"), materialise(lists, "lists")
    sources, folder, docs = roster.roster_table(spark, roster.parse_roster(text)), new_folder(spark, "state"), new_folder(spark, "docs")
    for stop in ("outbox", "commit", "files", None):

        def after(step: str, stop=stop) -> None:
            if step == stop:
                raise _Stopped(step)

        try:
            build.run(spark, sources, build.Inputs(pictures, lists), folder, docs, "https://o.example.com", NOW, after=after)
        except _Stopped:
            continue
    kept = store.Store(spark, folder)
    files = render.listed(spark, docs).select("file")
    of = F.regexp_extract("file", r"(nation-[0-9]+)[/.]", 1)
    kind = F.when(F.contains("file", F.lit("/img/")), "images").when(F.startswith("file", F.lit("recipes/")), "pages").otherwise("feeds")
    parts = [files.select(of.alias("source"), kind.alias("kind")), kept.read("catalog").select("source", F.lit("items").alias("kind")), kept.read("failures").select("source", F.lit("failures").alias("kind"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("source <> ''").groupBy("source", "kind").agg(F.count(F.lit(1)).alias("n"))


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    v for k, v in list(globals().items()) if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_") and v.__code__.co_varnames[:2] == ("spark", "d")
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}
