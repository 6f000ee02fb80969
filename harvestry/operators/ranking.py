"""Ranked, capped views of the catalog: feeds per source, per category and over all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.functions.dates import sort_date
from harvestry.sources.schemas import TOPS

PER_SOURCE_CAP, COMBINED_CAP, CATEGORY_CAP = 50, 100, 100
#: A list that is kept has so many times the rows that its feed shows.
SPARE = 2


def newest(rows: DataFrame, group: list[str], date: Column, ties: list[Column], cap: int) -> DataFrame:
    """The cap newest rows of each group, with their rank; ties by the given columns, ascending.

    The filter on the rank lets Spark cut each task's rows to cap a group before they are shuffled,
    so a group of any size comes to one task as few rows.
    """
    order = Window.partitionBy(*group).orderBy(date.desc(), *ties)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= cap)


def of_source(catalog: DataFrame, source: str) -> DataFrame:
    """Catalog rows of one source, in the order in which they came."""
    return catalog.filter(F.col("source") == source).orderBy("seq")


def of_category(catalog: DataFrame, category: str | None = None) -> DataFrame:
    """Catalog rows of one category; without one, all."""
    return catalog if category is None else catalog.filter(F.col("category") == category)


def with_roster(catalog: DataFrame, sources: DataFrame) -> DataFrame:
    """Catalog rows of enabled sources, with the source's place and the category that the roster gives."""
    rows = sources.filter("enabled").select(F.col("name").alias("__s"), F.col("ord").alias("src_ord"), F.col("category").alias("feed_category"))
    return catalog.join(F.broadcast(rows), F.col("source") == F.col("__s")).drop("__s")


def cap_of(feed: Column) -> Column:
    return F.when(F.startswith(feed, F.lit("source:")), PER_SOURCE_CAP).when(feed == "all", COMBINED_CAP).otherwise(CATEGORY_CAP)


def _dated(catalog: DataFrame, sources: DataFrame) -> DataFrame:
    return with_roster(catalog, sources).withColumn("sort_date", sort_date(F.col("published_at"), F.col("discovered_at")))


def _feeds_of(row_source: str = "source") -> list[tuple[Column, int]]:
    """The feeds that a row may be in, with their caps."""
    return [(F.concat(F.lit("source:"), F.col(row_source)), PER_SOURCE_CAP), (F.lit("all"), COMBINED_CAP), (F.concat(F.lit("category:"), F.col("feed_category")), CATEGORY_CAP)]


def feeds(catalog: DataFrame, sources: DataFrame, spare: int = 1) -> DataFrame:
    """All feeds' rows: `feed` (source:.., all, category:..), rank, and the catalog's columns; spare times as many as they show."""
    rows, out = _dated(catalog, sources), None
    for feed, cap in _feeds_of():
        part = newest(rows.withColumn("feed", feed), ["feed"], F.col("sort_date"), [F.col("src_ord"), F.col("seq")], cap * spare)
        out = part if out is None else out.unionByName(part)
    return out


def lists(catalog: DataFrame, sources: DataFrame) -> DataFrame:
    """TOPS of the whole catalog: the lists to keep, and whether there are more rows than a list has."""
    full = feeds(catalog, sources, SPARE)
    return full.withColumn("cut", F.max("rank").over(Window.partitionBy("feed")) >= SPARE * cap_of(F.col("feed"))).select(*TOPS.names)


def merged_lists(kept: DataFrame, touched: DataFrame, sources: DataFrame) -> DataFrame:
    """TOPS after rows of the catalog have been added or changed, from the lists alone.

    Below its last row nothing is known of a list that was cut, so what falls there goes. Such a
    list may become shorter than its feed: stale() names these, which have to be ranked anew.
    """
    place = F.struct((-F.unix_micros("sort_date")).alias("at"), "src_ord", "seq")
    old = _dated(kept, sources).withColumn("place", place)
    ends = old.filter("cut").groupBy(F.col("feed").alias("f")).agg(F.max("place").alias("end"))
    keys = touched.select(F.col("dedup_key").alias("k"))
    rest = old.join(keys, F.col("dedup_key") == F.col("k"), "left_anti").drop("rank", "cut")
    new = _dated(touched, sources).withColumn("place", place)
    fresh = new.withColumn("feed", F.explode(F.array(*[feed for feed, _ in _feeds_of()])))
    met = rest.unionByName(fresh.select(*rest.columns)).join(F.broadcast(ends), F.col("feed") == F.col("f"), "left").filter("end is null or place <= end")
    ranked = met.withColumns({"rank": F.row_number().over(Window.partitionBy("feed").orderBy("place")), "n": F.count(F.lit(1)).over(Window.partitionBy("feed"))})
    most = SPARE * cap_of(F.col("feed"))
    return ranked.filter(F.col("rank") <= most).withColumn("cut", F.col("end").isNotNull() | (F.col("n") >= most)).select(*TOPS.names)


def stale(merged: DataFrame, kept: DataFrame) -> list[str]:
    """The feeds that merged_lists() can't tell whole: cut ones with fewer rows than they show. Feeds are as many as the roster says."""
    sizes = merged.groupBy("feed").agg(F.count(F.lit(1)).alias("n"))
    cut = kept.filter("cut").select("feed").distinct().join(sizes, "feed", "left")
    return sorted(r["feed"] for r in cut.filter(F.coalesce("n", F.lit(0)) < cap_of(F.col("feed"))).collect())


def feed_roster(sources: DataFrame) -> DataFrame:
    """Feeds that are written even when empty: the combined one, and one for each category with an enabled source."""
    on = sources.filter("enabled")
    return on.select(F.concat(F.lit("category:"), F.col("category")).alias("feed")).distinct().unionByName(sources.sparkSession.createDataFrame([("all",)], "feed string"))


def source_counts(catalog: DataFrame, sources: DataFrame) -> DataFrame:
    """(category, ord, name, display_name, items) of each enabled source, 0 for one without items."""
    counts = catalog.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return (
        sources.filter("enabled").join(counts, F.col("name") == F.col("source"), "left").select("category", "ord", "name", "display_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("items"))
    )


def category_totals(counts: DataFrame) -> DataFrame:
    """Items per source and per category, in one pass; a null name is the category's total."""
    return counts.rollup("category", "name").agg(F.sum("items").alias("items")).filter("category is not null")
