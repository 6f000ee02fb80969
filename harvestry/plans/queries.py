"""Every operator applied to the test tables. Where a text needs structure it is made of relational
rows, so that an independent SQL query can say from the rows what must come out of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harvestry.functions import dates, text, urls
from harvestry.operators import captions, cards, ranking, state
from harvestry.scratch import new_folder
from harvestry.sinks import render
from harvestry.sinks.tables import Snapshots
from harvestry.sources import pages, saved_items, seeds, xml_feeds
from harvestry.sources.schemas import CATALOG, conform

NOW = "2024-02-01 00:00:00"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(name: str):
    return F.col(name).cast("timestamp")


def _ntz(c):
    return c.cast("timestamp_ntz")


def canonical_urls(spark, d):
    return _t(spark, d, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


def dedup_keys(spark, d):
    return _t(spark, d, "pages").select("page_id", urls.dedup_key(F.lit("pages"), F.col("url")).alias("dedup_key"))


def first_seen_refs(spark, d):
    rows = _t(spark, d, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("ref"))
    return xml_feeds.first_seen(rows, ["ref"], [F.col("page_id")]).select("ref", "page_id")


def _titles(spark, d):
    return _t(spark, d, "pages").select("page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


def title_slugs(spark, d):
    return _titles(spark, d).select("page_id", text.slugify(F.col("title")).alias("slug"))


def page_paths(spark, d):
    return _titles(spark, d).select("page_id", text.page_path(F.lit("pages"), F.col("title"), urls.dedup_key(F.lit("pages"), F.col("url"))).alias("path"))


def latest_per_host(spark, d):
    rows = _titles(spark, d).select("page_id", "title", urls.canonical_url(F.col("url")).alias("ref"))
    once = xml_feeds.first_seen(rows, ["ref"], [F.col("page_id")]).withColumn("host", F.regexp_extract("ref", "^https?://([^/?]+)", 1))
    key = urls.dedup_key(F.col("host"), F.col("ref"))
    top = ranking.newest(once, ["host"], F.col("page_id"), [F.col("ref")], ranking.PER_SOURCE_CAP)
    return top.select("host", "rank", "page_id", key.alias("dedup_key"), text.page_path(F.col("host"), F.col("title"), key).alias("path"))


def page_links(spark, d):
    p = _t(spark, d, "pages").select("page_id", "html")
    return p.select("page_id", F.posexplode(pages.anchors(F.col("html"))).alias("pos", "href")).withColumn("pos", F.col("pos").cast("bigint"))


def distinct_page_links(spark, d):
    p = _t(spark, d, "pages").select("page_id", "url", "html")
    return p.select("page_id", F.explode(pages.page_links(F.col("html"), F.col("url"))).alias("link"))


def pattern_links(spark, d):
    p = _t(spark, d, "pages").select("page_id", "url", "html")
    return p.select("page_id", F.explode(pages.page_links(F.col("html"), F.col("url"), "/[Tt]he?r?")).alias("link"))


def harvested_links(spark, d):
    p = _t(spark, d, "pages")
    host = F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    return pages.harvest(p.select(host.alias("source"), F.col("page_id").alias("page_ord"), "url", "html"))


def link_absolutize(spark, d):
    p = _t(spark, d, "pages")
    hrefs = F.array(*[F.lit(x) for x in ("/a/b/?x=1#y", "//cdn.example.com/z/", "https://o.example.com/p/q/", "mailto:a@b", "/")])
    return p.select("page_id", F.posexplode(hrefs).alias("pos", "href"), "url").select("page_id", F.col("pos").cast("bigint").alias("pos"), urls.absolutize(F.col("url"), F.col("href")).alias("link"))


def feed_per_source(spark, d):
    e = _t(spark, d, "events")
    return ranking.newest(e, ["event_type"], F.col("ts"), [F.col("event_id")], ranking.PER_SOURCE_CAP).select("event_type", F.col("rank").cast("bigint").alias("rank"), "event_id")


def feed_combined(spark, d):
    o = _t(spark, d, "orders")
    return ranking.newest(o.withColumn("feed", F.lit("all")), ["feed"], F.col("o_orderdate"), [F.col("o_orderpriority"), F.col("o_orderkey")], ranking.COMBINED_CAP).select(F.col("rank").cast("bigint").alias("rank"), "o_orderkey")


def feed_per_category(spark, d):
    o = _t(spark, d, "orders")
    return ranking.newest(o, ["o_orderpriority"], F.col("o_orderdate"), [F.col("o_orderkey")], ranking.CATEGORY_CAP).select("o_orderpriority", F.col("rank").cast("bigint").alias("rank"), "o_orderkey")


def feed_date_fallback(spark, d):
    o = _t(spark, d, "orders")
    first = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("ts"))
    published = F.when(F.col("o_orderkey") % 3 == 0, _ts("o_orderdate"))
    rows = o.join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.select("o_orderkey", _ntz(dates.sort_date(published, _ts("ts"))).alias("sort_date"))


def in_feed_flags(spark, d):
    e = _t(spark, d, "events")
    own = ranking.newest(e, ["event_type"], F.col("ts"), [F.col("event_id")], 50).select("event_id")
    every = ranking.newest(e.withColumn("feed", F.lit("all")), ["feed"], F.col("ts"), [F.col("event_id")], 100).select("event_id")
    rows = e.select(F.col("event_id").cast("string").alias("dedup_key"))
    keys = own.unionByName(every).select(F.col("event_id").cast("string").alias("dedup_key"))
    return state.mark_in_feed(rows, keys).select(F.col("dedup_key").cast("bigint").alias("event_id"), "in_feed")


def source_counts(spark, d):
    return _t(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("items"))


def category_rollup(spark, d):
    rows = _t(spark, d, "documents").groupBy(F.col("lang").alias("category"), F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("items"))
    return ranking.category_totals(rows)


def roster_left_join_counts(spark, d):
    nation, supplier = _t(spark, d, "nation"), _t(spark, d, "supplier")
    roster = nation.select(F.lit(True).alias("enabled"), F.col("n_regionkey").cast("string").alias("category"), F.col("n_nationkey").alias("ord"), F.col("n_name").alias("name"), F.lit("").alias("display_name"))
    catalog = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("source"))
    return ranking.source_counts(catalog, roster).select("category", "name", "items")


def new_refs_anti(spark, d):
    docs, labels = _t(spark, d, "documents"), _t(spark, d, "labels")
    refs = docs.select(F.col("doc_id").cast("string").alias("dedup_key"), "doc_id", "source")
    known = labels.select(F.col("doc_id").cast("string").alias("dedup_key"))
    none = spark.createDataFrame([], "dedup_key string, next_retry timestamp")
    return state.new_refs(refs, known, none, F.lit(NOW).cast("timestamp")).select("doc_id", "source")


def _failures(spark, d):
    e = _t(spark, d, "events").filter("event_type = 'error'").groupBy("user_id").agg(F.count(F.lit(1)).cast("int").alias("attempts"), F.max(_ts("ts")).alias("last"))
    return e.select("user_id", F.col("user_id").cast("string").alias("dedup_key"), "attempts", dates.next_retry(F.col("last"), F.col("attempts")).alias("next_retry"))


def suppressed_anti(spark, d):
    refs = _t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("dedup_key"), "c_custkey")
    none = spark.createDataFrame([], "dedup_key string")
    return state.new_refs(refs, none, _failures(spark, d), F.lit("2024-01-20 00:00:00").cast("timestamp")).select("c_custkey")


def failure_backoff(spark, d):
    return _failures(spark, d).select("user_id", F.col("attempts").cast("bigint").alias("attempts"), _ntz(F.col("next_retry")).alias("next_retry"))


def failure_records(spark, d):
    e = _t(spark, d, "events").select(F.col("user_id").cast("string").alias("dedup_key"), F.lit("events").alias("source"), F.lit("").alias("source_url"), "event_type", "ts")
    old = e.filter("event_type = 'error' and ts < timestamp_ntz'2024-01-02 00:00:00'").groupBy("dedup_key", "source", "source_url").agg(F.count(F.lit(1)).cast("int").alias("attempts"), F.max(_ts("ts")).alias("last_attempt"))
    old = old.withColumn("next_retry", dates.next_retry(F.col("last_attempt"), F.col("attempts")))
    late = e.filter("ts >= timestamp_ntz'2024-01-02 00:00:00'")
    out = state.record_failures(old, late.filter("event_type = 'error'"), late.filter("event_type = 'purchase' and cast(dedup_key as bigint) % 3 = 0").select("dedup_key").distinct(), F.lit(NOW).cast("timestamp"))
    return out.select(F.col("dedup_key").cast("bigint").alias("user_id"), F.col("attempts").cast("bigint").alias("attempts"), _ntz(F.col("next_retry")).alias("next_retry"))


def run_budget(spark, d):
    docs = _t(spark, d, "documents")
    refs = docs.select("source", F.col("doc_id").alias("ord"), "doc_id")
    sources = docs.select(F.col("source").alias("name")).distinct().withColumn("budget", F.length("name") * 3 + F.substring("name", 4, 2).cast("int"))
    return state.within_budget(refs, sources).select("source", "doc_id")


def catalog_upsert(spark, d):
    e = _t(spark, d, "events").select(F.col("user_id").cast("string").alias("dedup_key"), F.lit("events").alias("source"), F.lit("").alias("source_url"), F.lit("link_through").alias("mode"), F.col("event_type").alias("title"), _ts("ts").alias("ts"), F.col("event_id").alias("seq"))
    cut = F.lit("2024-01-03 00:00:00").cast("timestamp")
    early = e.filter(F.col("ts") < cut).groupBy("dedup_key").agg(*[F.max_by(c, "seq").alias(c) for c in ("source", "source_url", "mode", "title", "ts")], F.min("seq").alias("seq"))
    old = early.withColumns({"discovered_at": F.col("ts"), "page_url": F.concat(F.lit("p/"), F.col("dedup_key"))})
    old = conform(old).withColumn("content_hash", urls.content_hash(*[F.col(c) for c in ("title", "ingredients", "instructions", "image_url")]))
    out = state.upsert(old, e.filter(F.col("ts") >= cut), F.lit(NOW).cast("timestamp"))
    return out.select(F.col("dedup_key").cast("bigint").alias("user_id"), "title", "page_url", _ntz(F.col("discovered_at")).alias("discovered_at"), "changed")


def content_hash_changes(spark, d):
    c = _t(spark, d, "conversations")
    h = urls.content_hash(F.col("role"), F.col("text"), F.lit(""), F.lit(""))
    before = F.lag("h").over(Window.partitionBy("conv_id").orderBy("turn"))
    return c.withColumn("h", h).select("conv_id", "turn", F.col("h").alias("content_hash"), (~F.col("h").eqNullSafe(before)).alias("changed"))


def date_backfill(spark, d):
    o = _t(spark, d, "orders")
    base = o.select(F.col("o_orderkey").cast("string").alias("dedup_key"), F.lit("orders").alias("source"), F.lit("").alias("source_url"), F.lit("rehost").alias("mode"), F.when(F.col("o_orderkey") % 4 != 0, _ts("o_orderdate")).alias("published_at"))
    refs = _t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("dedup_key"), F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint").alias("ord"), F.when(F.col("l_linenumber") % 2 == 0, _ts("l_shipdate")).alias("date_hint"))
    return state.backfill_dates(conform(base), refs, F.lit(NOW).cast("timestamp")).select(F.col("dedup_key").cast("bigint").alias("o_orderkey"), _ntz(F.col("published_at")).alias("published_at"))


def emit_decision(spark, d):
    docs, labels = _t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels").select("doc_id", "quality")
    rows = docs.join(labels, "doc_id", "left").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "Saved").otherwise("").alias("saved_via"), (F.col("quality") == 1).alias("confident"), (F.col("doc_id") % 3 > 0).alias("has_confidence"))
    return cards.emit_decision(rows).select("doc_id", "emit", "full")


def minutes_iso(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").distinct()
    m = dates.number_minutes((F.col("l_quantity") * 7 - 30))
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"), m.cast("bigint").alias("minutes"), dates.iso_minutes(m).alias("iso"))


def human_duration(spark, d):
    p = _t(spark, d, "part")
    iso = F.when(F.col("p_partkey") % 5 == 0, F.col("p_name")).otherwise(dates.iso_minutes(F.col("p_size") * 11))
    return p.select("p_partkey", dates.human_duration(iso).alias("human"))


def split_tags(spark, d):
    p = _t(spark, d, "part")
    blob = F.concat(F.col("p_type"), F.lit(" / #"), F.lower("p_type"), F.lit(","), F.replace("p_name", F.lit(" "), F.lit("|")), F.lit(" |"), F.upper("p_name"))
    return p.select("p_partkey", F.array_join(text.split_tags(blob, F.col("p_brand")), ";").alias("tags"))


def nutrition_lines(spark, d):
    p = _t(spark, d, "part")
    facts = F.map_from_arrays(F.array(*[F.lit(k) for k in ("fatContent", "calories", "servingSize", "other")]), F.array(F.col("p_size").cast("string"), F.concat(F.col("p_partkey").cast("string"), F.lit(" kcal")), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(""), F.lit("x")))
    return p.select("p_partkey", text.nutrition_lines(facts).alias("nutrition"))


def feed_summary(spark, d):
    o = _t(spark, d, "orders")
    some = lambda n, c: F.when(F.col("o_orderkey") % n > 0, c).otherwise("")
    return o.select("o_orderkey", text.summary(some(2, F.col("o_orderpriority")), some(3, F.col("o_orderstatus")), some(5, F.col("o_custkey").cast("string")), F.lit("title")).alias("summary"))


def _captions(spark, d, *fields):
    """Fields of a caption for each order: a title, its items as ingredients, its ship dates as steps."""
    li = _t(spark, d, "lineitem").join(_t(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    rows = li.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_quantity").cast("int").alias("q"), "p_name", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")).alias("x"))
    one = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    lines = lambda f: F.array_join(F.transform("xs", f), "\n")
    caption = F.concat(
        F.lit("Order "),
        F.col("l_orderkey").cast("string"),
        F.lit(" 🍲 recipe in bio\n\nServes "),
        (F.col("l_orderkey") % 7 + 1).cast("string"),
        F.lit("\n450 kcal | 30g protein\nIngredients:\n"),
        lines(lambda x: F.concat(F.lit("- "), x["q"].cast("string"), F.lit("g "), x["p_name"])),
        F.lit("\nFor the sauce:\n• 100g sugar\n"),
        F.when(F.col("l_orderkey") % 3 > 0, F.concat(F.lit("Method\n"), F.array_join(F.transform("xs", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". Add by "), x["day"])), "\n"), F.lit("\nMakes 4 plates when all of it is shared out"))).otherwise(""),
        F.lit("\n#food #home"),
    )
    return one.select("l_orderkey", captions.parse_caption(caption, *fields).alias("p"))


def caption_titles(spark, d):
    return _captions(spark, d, "title", "nutrition", "description").select("l_orderkey", "p.title", "p.nutrition", F.col("p.description").alias("description"))


def caption_items(spark, d):
    return _captions(spark, d, "ingredients").select("l_orderkey", F.posexplode_outer("p.ingredients").alias("pos", "item")).filter("pos is not null").withColumn("pos", F.col("pos").cast("bigint"))


def caption_sections(spark, d):
    return _captions(spark, d, "ingredients", "instructions").select("l_orderkey", F.size("p.ingredients").cast("bigint").alias("ingredients"), F.size("p.instructions").cast("bigint").alias("instructions"))


def caption_steps(spark, d):
    return _captions(spark, d, "instructions").select("l_orderkey", F.posexplode_outer("p.instructions").alias("pos", "step")).filter("pos is not null").withColumn("pos", F.col("pos").cast("bigint"))


def caption_confident(spark, d):
    return _captions(spark, d, "confident").select("l_orderkey", "p.confident")


def caption_yield(spark, d):
    return _captions(spark, d, "servings").select("l_orderkey", F.col("p.servings").alias("servings"))


def caption_lines_documents(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", captions.parse_caption(F.col("text"), "description", "confident").alias("p"))
    return docs.select("doc_id", F.sha1(F.col("p.description").cast("binary")).alias("description_sha1"), "p.confident")


def steps_numbered(spark, d):
    c = _t(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.concat(F.lit(" "), x["role"], F.lit(": "), x["text"], F.lit(" \n "))), "\n").alias("t"))
    return c.select("conv_id", F.explode(cards.numbered_steps(F.col("t"))).alias("s")).select("conv_id", F.col("s.position").cast("bigint").alias("position"), "s.text")


def _cards(spark, d):
    p = _t(spark, d, "part")
    base = p.select(
        F.col("p_partkey").alias("seq"),
        F.col("p_partkey").cast("string").alias("dedup_key"),
        F.lit("parts").alias("source"),
        F.lit("").alias("source_url"),
        F.lit("link_through").alias("mode"),
        F.concat(F.col("p_name"), F.lit(" </b> "), F.col("p_partkey").cast("string")).alias("title"),
        F.concat(F.lit("# head\n"), F.col("p_brand"), F.lit("\n "), F.col("p_type")).alias("ingredients"),
        F.concat(F.lit("do "), F.col("p_size").cast("string"), F.lit("\n\nthen & stop")).alias("instructions"),
        dates.iso_minutes(F.col("p_size")).alias("total_time"),
        F.array(F.col("p_type"), F.lit("a,b")).alias("categories"),
        F.when(F.col("p_partkey") % 2 == 0, "Saved").otherwise("").alias("saved_via"),
    )
    return conform(base)


def jsonld_roundtrip(spark, d):
    from harvestry.plans.build import conform_cards  # noqa: F401  the same columns as a build's

    c = _cards(spark, d)
    html = F.concat(F.lit('<html><head><script type="application/ld+json">'), text.script_escape(cards.json_ld(F.lit(True))), F.lit("</script></head></html>"))
    rows = c.select("source", F.concat(F.lit("https://e.example.com/p/"), F.col("dedup_key")).alias("ref"), html.alias("html"), "mode", "category", F.lit("").alias("rehost_author"))
    out = pages.extract_records(rows)
    return out.select(F.regexp_extract("ref", "([0-9]+)$", 1).cast("bigint").alias("p_partkey"), "title", "ingredients", "instructions", "total_time", F.array_join("categories", ";").alias("tags"), "dedup_key")


def script_escape(spark, d):
    return _t(spark, d, "pages").select("page_id", F.sha1(text.script_escape(F.col("html")).cast("binary")).alias("escaped_sha1"))


def sitemap_parse(spark, d):
    p = _t(spark, d, "pages").withColumn("host", F.regexp_extract("url", "^https?://([^/?#]+)", 1))
    entry = F.concat(F.lit("<url><loc> "), text.xml_escape(F.col("url")), F.lit(" </loc>"), F.when(F.col("page_id") % 4 > 0, F.concat(F.lit("<lastmod>2024-01-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit("</lastmod>"))).otherwise("<!-- none -->"), F.lit("</url>"))
    xml = F.concat(F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", entry.alias("e")))), lambda x: x["e"]), "\n"), F.lit("</urlset>"))
    maps = p.groupBy("host").agg(xml.alias("xml"))
    rows = maps.select(F.col("host").alias("source"), F.lit(0).alias("doc"), F.posexplode(xml_feeds.sitemap_places(F.col("xml"))["urls"]).alias("pos", "x")).select("source", "doc", "pos", "x.loc", "x.lastmod")
    return xml_feeds.newest_first(rows).select("source", "ord", "loc", "lastmod")


def _dated(d, spark):
    e = _t(spark, d, "events")
    return e.select("event_id", "user_id", _ts("ts").alias("ts"))


def rss_parse(spark, d):
    e = _dated(d, spark)
    item = F.concat(F.lit("<item><title>t</title><link>https://e.example.com/"), F.col("event_id").cast("string"), F.lit("?a=1&amp;b=2</link><pubDate>"), F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate></item>"))
    xml = F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>c</title>'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", item.alias("i")))), lambda x: x["i"]), ""), F.lit("</channel></rss>"))
    feeds = e.groupBy("user_id").agg(xml.alias("body")).withColumn("url", F.concat(F.lit("f"), F.col("user_id").cast("string")))
    docs = feeds.select("url", F.lit("text").alias("kind"), "body", F.lit(True).alias("ok"))
    refs = xml_feeds.scan_feeds(feeds.select(F.col("user_id").alias("source"), F.col("url").alias("feed_url")), docs)
    return refs.select(F.col("source").alias("user_id"), "ord", "ref", _ntz(F.col("date_hint")).alias("date_hint"))


def atom_parse(spark, d):
    e = _dated(d, spark)
    link = lambda rel, path: F.concat(F.lit(f'<link rel="{rel}" href="https://e.example.com/{path}/'), F.col("event_id").cast("string"), F.lit('"/>'))
    entry = F.concat(F.lit("<entry><title>t</title>"), link("edit", "edit"), F.when(F.col("event_id") % 2 == 0, link("alternate", "p")).otherwise(""), F.lit("<updated>"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</updated></entry>"))
    xml = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", entry.alias("i")))), lambda x: x["i"]), ""), F.lit("</feed>"))
    rows = e.groupBy("user_id").agg(xml.alias("body")).select("user_id", F.posexplode(xml_feeds.feed_entries(F.col("body"))).alias("ord", "x"))
    return rows.select("user_id", F.col("ord").cast("bigint").alias("ord"), F.col("x.loc").alias("ref"), _ntz(dates.parse_date(F.col("x.raw_date"))).alias("date_hint"))


def date_parse_formats(spark, d):
    e = _t(spark, d, "events").select("event_id", _ts("ts").alias("ts"))
    forms = [F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.concat(F.date_format("ts", "MMMM d, yyyy")), F.lit("no date")]
    said = F.get(F.array(*forms), (F.col("event_id") % 5).cast("int"))
    return e.select("event_id", _ntz(dates.parse_date(said)).alias("parsed"))


def seed_parse(spark, d):
    c = _t(spark, d, "conversations")
    n = F.col("turn").cast("string")
    block = F.concat(F.lit("# note\nhttps://www.instagram.com/p/C"), F.col("conv_id").cast("string"), F.lit("x"), n, F.lit("/?igshid=z\ntags: "), F.col("role"), F.lit(", Quick/quick\nimage: https://i.example.com/"), n, F.lit(".jpg\n\n#first line\n"), F.col("text"), F.lit("\n"))
    lists = c.groupBy((F.col("conv_id") % 16).alias("k")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("conv_id", "turn", block.alias("b")))), lambda x: x["b"]), "\n===\n").alias("text"))
    out = seeds.seed_entries(lists.select(F.col("k").cast("string").alias("source"), "text"))
    return out.select("source", "ord", "ref", urls.shortcode(F.col("url")).alias("code"), "caption", "image_url", F.array_join("tags", ";").alias("tags"))


def saved_records(spark, d):
    e = _t(spark, d, "events").select("event_id", "event_type", "props", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("day"))
    raw = F.concat(
        F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('","title":"'), F.when(F.col("event_id") % 3 > 0, F.col("event_type")).otherwise(""), F.lit('","url":"'),
        F.when(F.col("event_id") % 2 == 0, F.lit("https://e.example.com/x")).otherwise("javascript:alert(1)"), F.lit('","created_at":"'), F.col("day"), F.lit('","tags":["A","a","'), F.col("event_type"),
        F.lit('"],"media":[{"kind":"x","mime_type":"image/png","url":"i1"},{"kind":"thumbnail","mime_type":"","url":"'), F.when(F.col("event_id") % 5 > 0, "i2").otherwise(""), F.lit('"}],"metadata":{"author":" au "},"summary":"s","props":'), F.col("props"), F.lit("}"),
    )
    i = F.from_json(raw, saved_items.ITEM)
    rows = e.select(F.lit("saves").alias("source"), F.lit("rehost").alias("mode"), F.lit("recipe").alias("category"), F.lit("").alias("rehost_author"), i.alias("i"), i.alias("detail"))
    out = saved_items.saved_records(rows)
    return out.select(F.regexp_extract("ref", "([0-9]+)$", 1).cast("bigint").alias("event_id"), "title", "source_url", "image_url", "author", F.array_join("categories", ";").alias("tags"), "dedup_key")


def safe_links(spark, d):
    p = _t(spark, d, "pages")
    u = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit(" "), F.upper("url"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("data:"), F.col("url"))).otherwise(F.col("url"))
    return p.select("page_id", text.safe_link(u).alias("link"), text.real_image(u).alias("real_image"))


def bundle_names(spark, d):
    p = _t(spark, d, "part").select(F.col("p_brand").alias("source"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("title"))
    return render.bundle_names(p).select("source", "seq", "file")


def bundle_records(spark, d):
    return _cards(spark, d).withColumn("images", F.array().cast("array<string>")).select(F.col("seq").alias("p_partkey"), cards.bundle_record().alias("record"))


def ingredient_lines(spark, d):
    c = _cards(spark, d).select(F.col("seq").alias("p_partkey"), F.posexplode(text.ingredient_lines(F.col("ingredients"))).alias("pos", "x"))
    return c.select("p_partkey", F.col("pos").cast("bigint").alias("pos"), "x.text", "x.is_header")


def provenance_tags(spark, d):
    return _cards(spark, d).select(F.col("seq").alias("p_partkey"), F.array_join(text.provenance_tags(F.col("categories"), F.col("saved_via")), ";").alias("tags"))


def emoji_titles(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey", text.strip_emoji(F.concat(F.lit("🍲 "), F.col("c_name"), F.lit("  ✨️ x"))).alias("title"))


def catalog_scan(spark, d):
    """A stored catalog, written by two versions, as it is scanned; one that was never written is empty."""
    few = _cards(spark, d).select("dedup_key", "source", "source_url", "mode", "title", "seq")
    stored = Snapshots(spark, new_folder(spark, "scan"), CATALOG, ("source",))
    empty = stored.read()
    stored.write(conform(few.withColumn("title", F.lit("old"))))
    stored.write(conform(few))
    c = stored.read().unionByName(empty)
    return c.select(F.col("seq").alias("p_partkey"), "title", "category", "saved_via", "in_feed", F.size("categories").cast("bigint").alias("n_tags"), F.col("published_at").isNull().alias("no_date"))


def feeds_all(spark, d):
    e = _t(spark, d, "events")
    catalog = e.select(F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("dedup_key"), F.col("event_type").alias("source"), F.lit("").alias("source_url"), F.lit("rehost").alias("mode"), F.when(F.col("event_id") % 2 == 0, _ts("ts")).alias("published_at"), _ts("ts").alias("discovered_at"))
    names = [("click", "recipe"), ("error", "cocktail"), ("purchase", "recipe"), ("signup", "cocktail")]
    sources = spark.createDataFrame([(i, n, c, True) for i, (n, c) in enumerate(names)] + [(9, "view", "recipe", False)], "ord int, name string, category string, enabled boolean")
    return ranking.feeds(conform(catalog), sources).select("feed", F.col("rank").cast("bigint").alias("rank"), F.col("seq").alias("event_id"))


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    v for k, v in list(globals().items()) if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_") and v.__code__.co_varnames[:2] == ("spark", "d")
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from harvestry.plans import scenarios

    return {q.__name__: q for q in QUERIES} | scenarios.queries()
