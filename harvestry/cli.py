"""python -m harvestry.cli: one build from a roster, fetched documents and seed lists."""

from __future__ import annotations

import argparse
import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from harvestry.plans import build
from harvestry.session import session
from harvestry.sinks import tables
from harvestry.sources import fetch, roster, saved_items, seeds
from harvestry.sources.schemas import DOCUMENTS


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="harvestry")
    p.add_argument("--base-url", default=os.environ.get("BASE_URL", "http://localhost:8000"), help="where the output folder will be served")
    p.add_argument("--sources", default="sources.yaml", help="the roster")
    p.add_argument("--documents", help="Parquet of fetched documents: url, kind, body, bytes, ok")
    p.add_argument("--fetch", help="folder of a store of documents: what is asked for and not there yet is got from the web and kept")
    p.add_argument("--saved", help="folder with the pages of a listing of saved items, and their details in details/{id}.json; a source's own url, or SAVED_ITEMS_URL, with SAVED_ITEMS_TOKEN, is asked instead")
    p.add_argument("--docs", default="docs", help="output folder")
    p.add_argument("--catalog", default="state", help="folder of the catalog and the failures")
    p.add_argument("--json", help="write the catalog as one JSON document here")
    p.add_argument("--backfill", action="store_true")
    p.add_argument("--bundles", action="store_true")
    p.add_argument("--only", action="append", default=[], help="process this source alone; may be repeated")
    return p


def main(argv: list[str] | None = None) -> dict:
    a = parser().parse_args(argv)
    spark = session()
    rows = roster.parse_roster(open(a.sources, encoding="utf-8").read())
    sources = roster.roster_table(spark, rows)
    docs = spark.read.schema(DOCUMENTS).parquet(a.documents) if a.documents else spark.createDataFrame([], DOCUMENTS)
    base = os.path.dirname(os.path.abspath(a.sources))
    lists = seeds.read_seeds(spark, [(r["name"], os.path.join(base, r["seed_file"])) for r in rows if r["discovery"] == "seed_list" and r["seed_file"]])
    saved = details = None
    if any(r["discovery"] == "saved_items" for r in rows):
        token = os.environ.get("SAVED_ITEMS_TOKEN", "")
        windows = {r["name"]: r["window"] for r in roster.with_limits(sources, a.backfill).collect()}  # a row a source
        where = lambda r: r["url"] or os.environ.get("SAVED_ITEMS_URL") or a.saved or ""
        places = [saved_items.Place(r["name"], where(r), windows[r["name"]] or 1 << 30) for r in rows if r["discovery"] == "saved_items"]
        saved = saved_items.listings(spark, places, token).select("source", "ord", "i")
        files = sorted({p.address for p in places if p.address and not p.address.startswith("http")})
        details = saved_items.live_details(places, token) if not files else saved_items.detail_files(spark, f"{files[0]}/details")
    settings = sources.select(F.col("name").alias("source"), F.col("request_delay_seconds").alias("delay"), F.nullif("user_agent", F.lit("")).alias("agent"))
    fetcher = fetch.Fetcher(spark, a.fetch, settings=settings, as_agent=fetch.web_client) if a.fetch else None
    inputs = build.Inputs(docs, lists, saved, details, fetcher)
    out = build.run(spark, sources, inputs, a.catalog, a.docs, a.base_url, datetime.now(timezone.utc).replace(tzinfo=None), a.backfill, a.bundles, a.only)
    if a.json:
        store = build.Store(spark, a.catalog)
        tables.write_document(tables.catalog_lines(store.read("catalog"), store.read("failures"), datetime.now(timezone.utc)), a.json)
    print(out)
    return out


if __name__ == "__main__":
    main()
