import json
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from harvestry.operators import cards
from harvestry.plans import build
from harvestry.scratch import materialise
from harvestry.sources import roster, saved_items
from harvestry.sources.schemas import DOCUMENTS

NOW = datetime(2026, 1, 5, 12)
ROSTER = """
defaults: {max_new_per_run: 3}
sources:
- {name: web, mode: link_through, discovery: sitemap, sitemap: "https://e.org/map.xml", url_pattern: "/r/", display_name: The Web}
- {name: posts, mode: rehost, discovery: seed_list, rehost_author: Poster}
- {name: mine, mode: rehost, discovery: saved_items}
- {name: drinks, mode: rehost, discovery: seed_list, category: cocktail}
- {name: "off", mode: rehost, discovery: seed_list, enabled: false}
"""
SEEDS = "https://www.instagram.com/p/A/\nimage: https://i.org/a.jpg\n\nBean Soup\nIngredients:\n- beans\nMethod:\nBoil <well>\n===\nhttps://www.instagram.com/p/B/\nimage: https://i.org/b.jpg\n\nOnly words\n"


def page(name, date=None):
    ld = {"@type": "Recipe", "name": name, "recipeIngredient": ["x"], "image": "https://i.org/x.jpg"} | ({"datePublished": date} if date else {})
    return f'<script type="application/ld+json">{json.dumps(ld)}</script>'


def inputs(spark):
    urls = "".join(f"<url><loc>https://e.org/r/{i}</loc><lastmod>2025-01-0{i}</lastmod></url>" for i in range(1, 6))
    rows = [("https://e.org/map.xml", "text", f"<urlset>{urls}<url><loc>https://e.org/about</loc></url></urlset>", None, True)]
    rows += [(f"https://e.org/r/{i}", "text", page(f"R {i}", "2024-06-01" if i == 5 else None) if i != 4 else "<p>no record</p>", None, True) for i in range(1, 6)]
    rows += [("https://i.org/a.jpg", "bytes", None, b"\xff\xd8\xff\x00", True), ("https://i.org/b.jpg", "bytes", None, b"<html>", True)]
    item = '{"id":"7","title":"Kept","summary":"words","created_at":"2025-05-05","tags":["t"]}'
    saved = spark.createDataFrame([("mine", 0, item)], "source string, ord bigint, j string").selectExpr("source", "ord", f"from_json(j, '{saved_items.ITEM}') as i")
    lists = spark.createDataFrame([("posts", SEEDS), ("drinks", "# none yet\n")], "source string, text string")
    return build.Inputs(spark.createDataFrame(rows, DOCUMENTS), lists, saved)


def run(spark, folder, now=NOW, **how):
    sources = roster.roster_table(spark, roster.parse_roster(ROSTER))
    return build.run(spark, sources, inputs(spark), f"file://{folder}/state", str(folder / "docs"), "https://out.org", now, **how)


def test_two_runs(spark, tmp_path):
    first = run(spark, tmp_path, make_bundles=True)
    # of the three newest pages one has no record; two posts and a saved item
    counts = first.pop("sources")
    assert first == {"added": 5, "total": 5, "bundles": {"web": 2, "posts": 2, "mine": 1}}
    assert counts["web"] == {"discovered": 5, "new": 5, "processing": 3, "added": 2} and counts["drinks"]["discovered"] == 0 and list(counts) == ["web", "posts", "mine", "drinks"]
    from harvestry.sinks.store import Store

    catalog = {r.title: r for r in Store(spark, f"file://{tmp_path}/state").read("catalog").collect()}
    assert sorted(catalog) == ["Bean Soup", "Kept", "Only words", "R 3", "R 5"]
    assert str(catalog["R 5"].published_at) == "2024-06-01 00:00:00" and str(catalog["R 3"].published_at) == "2025-01-03 00:00:00"
    assert catalog["R 5"].page_url == "https://e.org/r/5" and all(r.in_feed for r in catalog.values())
    soup = catalog["Bean Soup"]
    assert soup.image_url.startswith("https://out.org/recipes/posts/img/bean-soup-") and soup.local_image and catalog["Only words"].image_url == ""
    assert sorted(r.seq for r in catalog.values()) == [0, 1, 2, 3, 4]
    docs = tmp_path / "docs"
    feed = (docs / "feed.xml").read_text()
    order = [feed.index(f"<title>{t}</title>") for t in ("Bean Soup", "Kept", "R 3", "R 5")]
    assert order == sorted(order) and feed.count("<item>") == 5
    assert (docs / "cocktails.xml").read_text().count("<item>") == 0 and not (docs / "feeds/drinks.xml").exists()
    assert "<category>Saved</category>" in (docs / "feeds/mine.xml").read_text()
    html = (docs / soup.page_url.removeprefix("https://out.org/")).read_text()
    assert '"recipeIngredient":["beans"]' in html and "Boil \\u003cwell\\u003e" in html and "<li>Boil &lt;well&gt;</li>" in html and "Author: Poster" in html
    # the hosted image lies where the page, the feed and the catalog say
    assert (docs / soup.local_image).read_bytes() == b"\xff\xd8\xff\x00" and soup.image_url == f"https://out.org/{soup.local_image}" and soup.image_url in html
    assert [x.name for x in (docs / "recipes/posts/img").iterdir()] == [soup.local_image.rsplit("/", 1)[1]]
    assert 'rel="self"' in feed and "<lastBuildDate>Mon, 05 Jan 2026 12:00:00 +0000</lastBuildDate>" in feed and "https://out.org/feed.xml" in feed
    words = (docs / catalog["Only words"].page_url.removeprefix("https://out.org/")).read_text()
    assert "ld+json" not in words
    kept = (docs / catalog["Kept"].page_url.removeprefix("https://out.org/")).read_text()
    assert '"recipeCategory":["Saved","t"]' in kept and "recipeIngredient" not in kept and "Kept in: Saved" in kept
    with zipfile.ZipFile(docs / "bundles/posts.zip") as z:
        assert sorted(z.namelist()) == ["bean-soup.json", "only-words.json"]
        soup_record = json.loads(z.read("bean-soup.json"))
        assert list(soup_record)[:5] == ["id", "title", "text", "images", "categories"] and soup_record["images"] == ["/9j/AA=="]
    index = (docs / "index.html").read_text()
    assert "The Web" in index and "awaiting first import" in index and "Off" not in index
    again = run(spark, tmp_path)  # what had no record waits; the two older pages come now
    assert again["added"] == 2 and again["total"] == 7
    assert run(spark, tmp_path)["added"] == 0
    later = run(spark, tmp_path, now=datetime(2026, 2, 1), only=["posts"])
    assert (later["added"], later["total"], list(later["sources"])) == (0, 7, ["posts"])


def test_what_is_missing_is_fetched_once_and_kept(spark, tmp_path):
    from pyspark.sql import functions as F

    from harvestry.sources import fetch

    full = inputs(spark)
    web = {r.url: (r.body.encode() if r.body is not None else bytes(r.bytes)) for r in full.documents.collect()}
    log = tmp_path / "asked"
    log.mkdir()

    def get(url):
        import uuid

        (log / uuid.uuid4().hex).write_text(url)
        return web[url]

    fetch_once = fetch.Fetcher(spark, f"file://{tmp_path}/cache", get, delay=0, hosts=2)
    got = build.Inputs(spark.createDataFrame([], DOCUMENTS), full.seed_lists, full.saved, None, fetch_once)
    sources = roster.roster_table(spark, roster.parse_roster(ROSTER))
    go = lambda: build.run(spark, sources, got, f"file://{tmp_path}/state", str(tmp_path / "docs"), "https://out.org", NOW)
    first = go()
    assert first["added"] == 5 and first["sources"]["web"]["discovered"] == 5
    asked = [p.read_text() for p in log.iterdir()]
    # the sitemap, three pages, two images: nothing twice, and not the pages beyond the budget
    assert sorted(asked) == sorted({"https://e.org/map.xml", *(f"https://e.org/r/{i}" for i in (3, 4, 5)), "https://i.org/a.jpg", "https://i.org/b.jpg"})
    assert fetch_once.documents().filter(F.col("kind") == "bytes").count() == 2
    go()
    asked = [p.read_text() for p in log.iterdir()]
    assert len(asked) == len(set(asked)) == 8  # two more pages


def test_a_write_that_stops_leaves_the_old_table(spark, tmp_path):
    import shutil

    from harvestry.sinks.tables import Snapshots
    from harvestry.sources.schemas import FAILURES

    table = Snapshots(spark, f"file://{tmp_path}/t", FAILURES)
    row = lambda k: spark.createDataFrame([(k, "s", "u", 1, NOW, NOW)], FAILURES)
    assert table.version() == 0 and table.read().count() == 0
    table.write(row("a"))
    shutil.copytree(tmp_path / "t/v=1", tmp_path / "t/v=2")
    (tmp_path / "t/v=2/_SUCCESS").unlink()  # a second write that didn't come to its end
    assert table.version() == 1 and table.read().first().dedup_key == "a"
    assert table.write(row("b")).first().dedup_key == "b" and table.version() == 3
    for k in "cdef":
        table.write(row(k))
    assert table.read().first().dedup_key == "f" and sum(v[1] for v in table._versions()) == Snapshots.KEPT


def test_new_rows_are_numbered_in_ranges(spark):
    from harvestry.operators import state

    rows = spark.range(5000).selectExpr("cast(id as string) dedup_key", "case when id % 10 = 0 then id div 10 end seq", "(id * 7919) % 5003 as __order").repartition(4)
    got = state.numbered(rows, 499)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    new = sorted((r["__order"], r.dedup_key) for r in rows.filter("seq is null").collect())
    seqs = {r.dedup_key: r.seq for r in got.collect()}
    assert [seqs[k] for _, k in new] == list(range(500, 500 + len(new)))


def test_emit_decision(spark):
    rows = [("", None, False), ("", True, True), ("", False, True), ("", None, True), ("S", False, True), ("S", True, True)]
    got = cards.emit_decision(spark.createDataFrame(rows, "saved_via string, confident boolean, has_confidence boolean")).collect()
    assert [(r.emit, r.full) for r in got] == [(True, True), (True, True), (False, True), (False, True), (True, False), (True, True)]


def test_bundle_names_probe(spark):
    from harvestry.sinks import render

    rows = [("s", i, t) for i, t in enumerate(["Same", "Same 2", "Same", "Same", "Other", "Same 2"])] + [("z", 0, "Same")]
    got = render.bundle_names(spark.createDataFrame(rows, "source string, seq bigint, title string")).orderBy("source", "seq").collect()
    assert [r.file for r in got] == ["same.json", "same-2.json", "same-3.json", "same-4.json", "other.json", "same-2-2.json", "same.json"]


def test_bundle_names_against_one_row_after_the_other(spark):
    import random

    from harvestry.sinks import render

    r = random.Random(9)
    rows = []
    for source in range(60):
        pool = r.sample(["a", "a 2", "a 3", "a 2 2", "a 2 3", "a 4", "a 02", "a 1", "b", "b 2", "a 3 2", "a 2 2 2", "a 12", "b 3"], r.randrange(1, 9))
        rows += [(f"s{source}", i, r.choice(pool)) for i in range(r.randrange(1, 40))]
    want = []
    for source in sorted({s for s, _, _ in rows}):
        taken, upto = set(), {}
        for s, seq, title in sorted(x for x in rows if x[0] == source):
            own = title.replace(" ", "-")
            n, out = upto.get(own, 1), own
            while out in taken:
                n += 1
                out = f"{own}-{n}"
            upto[own] = n
            taken.add(out)
            want.append((s, seq, f"{out}.json"))
    got = render.bundle_names(spark.createDataFrame(rows, "source string, seq bigint, title string").repartition(3))
    assert sorted((x.source, x.seq, x.file) for x in got.collect()) == sorted(want)
    plan = got._jdf.queryExecution().toString()
    assert "FlatMapGroups" not in plan


def test_stream_replays_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    from harvestry.operators import state
    from harvestry.sinks.store import Store
    from harvestry.streaming import incremental

    def parse(todo):
        good = todo.filter("ref like '%good%'")
        return good.select("dedup_key", "source", F.col("ref").alias("source_url"), F.lit("link_through").alias("mode"), F.col("ref").alias("title"), F.col("ord").alias("seq"))

    def land(*refs):
        rows = spark.createDataFrame([("s", i, r, None) for i, r in enumerate(refs)], "source string, ord bigint, ref string, date_hint timestamp")
        state.keyed(rows).write.mode("append").parquet(str(tmp_path / "refs"))

    def go():
        incremental.start(spark, str(tmp_path / "refs"), f"file://{tmp_path}/state", str(tmp_path / "cp"), parse, lambda: F.lit("2026-01-01 00:00:00").cast("timestamp")).awaitTermination()
        store = Store(spark, f"file://{tmp_path}/state")
        return store.read("catalog"), store.read("failures")

    land("https://e.org/good/1", "https://e.org/bad")
    catalog, failures = go()
    assert catalog.count() == 1 and failures.first().attempts == 1
    land("https://e.org/good/1", "https://e.org/good/2", "https://e.org/bad")
    catalog, failures = go()
    assert sorted(r.title[-1] for r in catalog.collect()) == ["1", "2"] and failures.first().attempts == 1


def test_stream_of_documents_publishes_each_item_once(spark, tmp_path):
    """Documents that land in two batches, the second replayed, leave what one build of all of them leaves."""
    import os

    from harvestry.sinks.store import Store
    from harvestry.streaming import incremental

    roster_text = 'defaults: {max_new_per_run: 9}\nsources:\n- {name: web, mode: link_through, discovery: native_feed, feed_url: "https://e.org/feed"}\n- {name: posts, mode: rehost, discovery: seed_list}\n'
    sources = roster.roster_table(spark, roster.parse_roster(roster_text))
    lists = spark.createDataFrame([("posts", SEEDS)], "source string, text string")

    def documents(upto, images):
        items = "".join(f"<item><link>https://e.org/r/{i}</link></item>" for i in range(1, upto + 1))
        rows = [("https://e.org/feed", "text", f"<rss><channel>{items}</channel></rss>", None, True)] + [(f"https://e.org/r/{i}", "text", page(f"R {i}"), None, True) for i in range(1, upto + 1)]
        return spark.createDataFrame(rows + [(f"https://i.org/{n}.jpg", "bytes", None, b"\xff\xd8\xff\x00", True) for n in images], DOCUMENTS)

    def left(folder):
        files = {os.path.relpath(os.path.join(d, f), folder / "docs"): open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(folder / "docs") for f in names}
        rows = Store(spark, f"file://{folder}/state").read("catalog").drop("seq", "last_seen_at").collect()
        return files, sorted(map(tuple, rows), key=repr)

    one = tmp_path / "one"
    build.run(spark, sources, build.Inputs(documents(4, "ab"), lists), f"file://{one}/state", str(one / "docs"), "https://out.org", NOW)
    two = tmp_path / "two"

    def go():
        inputs = build.Inputs(documents(0, ""), lists)
        incremental.start_builds(spark, str(two / "landing"), f"file://{two}/kept", f"file://{two}/state", str(two / "docs"), "https://out.org", str(two / "cp"), sources, inputs, lambda: NOW).awaitTermination()

    documents(2, "ab").write.mode("append").parquet(str(two / "landing"))
    go()
    assert len(left(two)[1]) == 4
    documents(4, "").write.mode("append").parquet(str(two / "landing"))
    go()
    # the last batch counts as not taken, as after a stop before its end: it is replayed
    for f in (two / "cp/commits").iterdir():
        if f.name.strip(".").startswith("1"):
            f.unlink()
    go()
    assert left(two) == left(one)


def test_command_line(spark, tmp_path):
    from harvestry import cli

    (tmp_path / "sources.yaml").write_text("sources:\n- {name: posts, mode: rehost, discovery: seed_list, seed_file: a.txt}\n")
    (tmp_path / "a.txt").write_text(SEEDS)
    got = cli.main(["--sources", str(tmp_path / "sources.yaml"), "--docs", str(tmp_path / "docs"), "--catalog", f"file://{tmp_path}/state", "--base-url", "https://o.org"])
    assert got["added"] == 2 and (tmp_path / "docs/index.html").exists()


def test_catalog_json_round_trip(spark, tmp_path):
    from harvestry.sinks.tables import import_json
    from harvestry.sources.schemas import FAILURES

    (tmp_path / "c.json").write_text(json.dumps({"version": 1, "recipes": {"k": {"dedup_key": "k", "source": "s", "source_url": "u", "mode": "rehost", "title": "é"}}}, ensure_ascii=False))
    got = import_json(spark, str(tmp_path / "c.json"))
    assert (got.first().title, got.first().seq, got.first().category) == ("é", 0, "recipe")
    from harvestry.sinks.tables import catalog_lines, write_document

    two = spark.createDataFrame([("x\"y", "s", "u2", 3, NOW, NOW), ("a", "s", "u", 1, NOW, NOW)], FAILURES)
    write_document(catalog_lines(got, two, NOW), f"file://{tmp_path}/out.json")
    write_document(catalog_lines(got, two, NOW), f"file://{tmp_path}/out.json")  # replaces the first
    text = (tmp_path / "out.json").read_text()
    whole = json.loads(text)
    assert (whole["version"], whole["count"], whole["generated_at"]) == (1, 1, "2026-01-05T12:00:00") and "é" in text
    assert whole["recipes"]["k"]["title"] == "é" and list(whole["failures"]) == ["a", 'x"y'] and whole["failures"]['x"y']["attempts"] == 3
    again = import_json(spark, str(tmp_path / "out.json"))
    assert again.drop("seq").collect() == got.drop("seq").collect()
    write_document(catalog_lines(got.limit(0), two.limit(0), NOW), f"file://{tmp_path}/none.json")
    assert json.loads((tmp_path / "none.json").read_text())["recipes"] == {}


@pytest.mark.parametrize("way, record", [("discovery: native_feed, feed_url: https://e.org/at", "R"), ("discovery: index_page, url: https://e.org/at, url_pattern: /recipes/", "R"), ("discovery: chef_page, url: https://e.org/at", "R"), ("discovery: seed_list", "Said")])
def test_documents_are_never_broadcast(spark, way, record):
    """Many pages in a small file: the roster and the few refs go to them, whatever Spark thinks of their sizes."""
    at = '<a href="/recipes/a-1">x</a>' if "page" in way else "<rss><channel><item><link>https://e.org/recipes/a-1</link></item></channel></rss>"
    post = "https://www.instagram.com/p/A/"
    rows = [("https://e.org/at", "text", at, None, True), ("https://e.org/recipes/a-1", "text", page("R"), None, True), (post, "text", '{"title": "Said"}', None, True)]
    long = F.concat(F.lit('<meta property="og:description" content="'), F.repeat(F.lit("x"), 40000), F.lit('">'))
    many = spark.range(4000).select(F.concat(F.lit("https://e.org/x/"), "id").alias("url"), F.lit("text").alias("kind"), long.alias("body"), F.lit(None).cast("binary").alias("bytes"), F.lit(True).alias("ok"))
    documents = materialise(many.unionByName(spark.createDataFrame(rows, DOCUMENTS)).coalesce(1), "documents")  # 160 MB of texts
    sources = roster.with_limits(roster.roster_table(spark, roster.parse_roster(f"sources:\n- {{name: s, mode: link_through, {way}}}\n")), False)
    given = build.Inputs(documents, spark.createDataFrame([("s", post + "\n")], "source string, text string"))
    spark.conf.set("spark.sql.maxBroadcastTableSize", str(100 << 20))  # a single row counts as a page of memory, 32 MB at this session's heap
    try:
        refs = materialise(build.discover(spark, sources, given), "refs")
        assert [r.title for r in build.parse(refs, sources, given).collect()] == [record]
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
