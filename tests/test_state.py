from datetime import datetime

import pytest
from pyspark.sql import functions as F

from harvestry.operators import ranking, state
from harvestry.sources.schemas import CATALOG, FAILURES, conform



def day(n):
    return F.lit(f"2026-01-0{n} 00:00:00").cast("timestamp")


def rows(spark, *dicts):
    kinds = {f.name: f.dataType for f in CATALOG}
    names = sorted({k for d in dicts for k in d})
    from pyspark.sql import types as T

    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in dicts], T.StructType([T.StructField(n, kinds[n]) for n in names]))


def recipe(key, title="t", seq=0, **more):
    return {"dedup_key": key, "source": "s", "source_url": f"https://e.org/{key}", "mode": "rehost", "title": title, "seq": seq} | more


def empty(spark, schema=CATALOG):
    return spark.createDataFrame([], schema)


def test_upsert_keeps_what_came_first(spark):
    first = state.upsert(empty(spark), rows(spark, recipe("a", page_url="p/a"), recipe("b", seq=1)), day(1)).drop("changed")
    again = state.upsert(first, rows(spark, recipe("a"), recipe("c", seq=5)), day(2))
    got = {r.dedup_key: r for r in again.collect()}
    assert [got[k].seq for k in "abc"] == [0, 1, 2]
    assert got["a"].page_url == "p/a" and got["a"].discovered_at == datetime(2026, 1, 1) and got["a"].last_seen_at == datetime(2026, 1, 2)
    assert (got["a"].changed, got["b"].changed, got["c"].changed) == (False, False, True)
    assert got["c"].discovered_at == datetime(2026, 1, 2)


def test_upsert_overwrites_and_sees_changes(spark):
    first = state.upsert(empty(spark), rows(spark, recipe("a", published_at=datetime(2025, 1, 1))), day(1), backfill=True).drop("changed")
    got = state.upsert(first, rows(spark, recipe("a", title="x", published_at=None), recipe("a", title="y", seq=3, published_at=None)), day(2)).first()
    assert got.title == "y" and got.changed and got.published_at is None and got.backfill is True


def test_failures_back_off(spark):
    failed = spark.createDataFrame([("k", "s", "u")], "dedup_key string, source string, source_url string")
    none = spark.createDataFrame([], "dedup_key string")
    one = state.record_failures(empty(spark, FAILURES), failed, none, day(1))
    assert (one.first().attempts, one.first().next_retry) == (1, datetime(2026, 1, 3))
    two = state.record_failures(one, failed, none, day(1))
    assert (two.first().attempts, two.first().next_retry) == (2, datetime(2026, 1, 5))
    refs = spark.createDataFrame([("k",), ("l",)], "dedup_key string")
    left = lambda now: sorted(r[0] for r in state.new_refs(refs, none, one, F.lit(now).cast("timestamp")).collect())
    assert left("2026-01-01 12:00:00") == ["l"] and left("2026-01-03 00:00:00") == ["k", "l"]
    assert state.record_failures(two, failed.limit(0), failed.select("dedup_key"), day(1)).count() == 0


def test_budget_is_per_source(spark):
    refs = spark.createDataFrame([("a", i) for i in range(5)] + [("b", i) for i in range(5)], "source string, ord bigint")
    caps = spark.createDataFrame([("a", 2), ("b", None)], "name string, budget int")
    got = state.within_budget(refs, caps).groupBy("source").count().collect()
    assert {r[0]: r[1] for r in got} == {"a": 2, "b": 5}


def test_dates_are_never_overwritten(spark):
    base = conform(rows(spark, recipe("a", published_at=None), recipe("b", published_at=datetime(2020, 1, 1))))
    refs = spark.createDataFrame([("a", 0, datetime(2024, 1, 1)), ("b", 1, datetime(2024, 1, 1))], "dedup_key string, ord bigint, date_hint timestamp")
    got = {r.dedup_key: r.published_at for r in state.backfill_dates(base, refs, day(1)).collect()}
    assert got == {"a": datetime(2024, 1, 1), "b": datetime(2020, 1, 1)}


def test_feeds_rank_and_cap(spark):
    days = [recipe(f"k{i}", seq=i, published_at=datetime(2024, 1, 1 + i % 3)) for i in range(120)]
    sources = spark.createDataFrame([("s", 0, "recipe", True, ""), ("z", 1, "cocktail", True, "Z")], "name string, ord int, category string, enabled boolean, display_name string")
    got = ranking.feeds(conform(rows(spark, *days)), sources)
    assert {r[0]: r[1] for r in got.groupBy("feed").count().collect()} == {"source:s": 50, "all": 100, "category:recipe": 100}
    top = [r.seq for r in got.filter("feed = 'source:s'").orderBy("rank").limit(3).collect()]
    assert top == [2, 5, 8]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert {r["feed"] for r in ranking.feed_roster(sources).collect()} == {"all", "category:recipe", "category:cocktail"}
    counts = {r["name"]: r["items"] for r in ranking.source_counts(conform(rows(spark, *days)), sources).collect()}
    assert counts == {"s": 120, "z": 0}


def test_conform_defaults_and_needs(spark):
    got = conform(rows(spark, recipe("a"))).first()
    assert got.category == "recipe" and got.text == "" and got.categories == [] and got.in_feed is False and got.published_at is None
    with pytest.raises(ValueError, match="source_url"):
        conform(rows(spark, {"dedup_key": "a", "source": "s", "mode": "rehost"}))


def test_mark_in_feed(spark):
    keys = spark.createDataFrame([("a",), ("a",)], "dedup_key string")
    got = state.mark_in_feed(conform(rows(spark, recipe("a"), recipe("b", in_feed=True))), keys).collect()
    assert {r.dedup_key: r.in_feed for r in got} == {"a": True, "b": False}


def test_kept_lists_follow_the_catalog(spark):
    import random

    from harvestry.scratch import materialise
    from harvestry.sinks.store import overlay

    r = random.Random(5)
    sources = spark.createDataFrame([("s", 0, "recipe", True), ("z", 1, "cocktail", True), ("off", 2, "recipe", False)], "name string, ord int, category string, enabled boolean")

    def some(n, first, days):
        return conform(rows(spark, *[recipe(f"k{i}", seq=i, published_at=datetime(2024, r.choice(days), 1 + r.randrange(28))) | {"source": "szsz"[i % 4] if i % 9 else "off"} for i in r.sample(range(first, first + n), n)]))

    shows = lambda part: sorted((x.feed, x.rank, x.dedup_key) for x in part.filter(F.col("rank") <= ranking.cap_of(F.col("feed"))).collect())
    catalog = materialise(some(420, 0, [5, 6]), "c")
    kept, anew = materialise(ranking.lists(catalog, sources), "k"), 0
    assert {x.feed: x.n for x in kept.groupBy("feed").agg(F.count(F.lit(1)).alias("n")).collect()}["all"] == 200
    for step, (n, first, days) in enumerate([(30, 420, [7]), (90, 0, [1, 2]), (160, 100, [1]), (200, 200, [1, 8])]):
        touched = materialise(some(n, first, days), "t")
        catalog = materialise(overlay(catalog, touched), "c")
        merged = materialise(ranking.merged_lists(kept, touched, sources), "m")
        again = ranking.stale(merged, kept)
        anew += len(again)
        full = ranking.lists(catalog, sources)
        merged = merged.filter(~F.col("feed").isin(again)).unionByName(full.filter(F.col("feed").isin(again)))
        assert shows(merged) == shows(full), step
        kept = materialise(merged, "k")
    assert 0 < anew < 16
