"""The incremental build as a stream: every batch is taken in and published once, however often it is replayed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harvestry.operators import state
from harvestry.plans import build
from harvestry.scratch import materialise
from harvestry.sinks.store import Store, gone
from harvestry.sources.documents import DocumentStore
from harvestry.sources.schemas import DOCUMENTS, FAILURES, REFS, conform


def merge_batch(refs: DataFrame, store: Store, parse: Callable[[DataFrame], DataFrame], now: Column) -> None:
    """Parse the refs that are new and due, and put the catalog's and the failures' changes in force, both or none.

    Replaying a batch changes nothing: its items are known by then, and its failures wait.
    """
    catalog, failed = store.read("catalog"), store.read("failures")
    todo = materialise(state.new_refs(refs.dropDuplicates(["dedup_key"]), catalog, failed, now), "todo")
    records = materialise(parse(todo), "records")
    lost = todo.join(records.select("dedup_key"), "dedup_key", "left_anti").selectExpr("dedup_key", "source", "ref as source_url")
    last = store.head()["facts"].get("last", -1)
    made = materialise(conform(state.changes(store.rows_of("catalog", records), records, now, last).drop("changed")), "made")
    healed = failed.join(records.select(F.col("dedup_key").alias("__k")), F.col("dedup_key") == F.col("__k"), "left_semi")
    again = state.failure_changes(failed, lost, now).withColumn("__gone", F.lit(False))
    top = made.agg(F.max("seq")).first()[0]
    # no feeds are ranked here, so that a build that follows does it anew
    store.commit({"catalog": made, "failures": again.unionByName(gone(healed, FAILURES))}, roster=None, last=max(last, -1 if top is None else top))
    store.compact_if_due()


def start(spark: SparkSession, refs_folder: str, state_folder: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame], now: Callable[[], Column]) -> StreamingQuery:
    """Take in all refs (REFS, Parquet) that have come into a folder since the last time, then stop; nothing is published."""
    store = Store(spark, state_folder)
    stream = spark.readStream.schema(REFS).parquet(refs_folder)
    return stream.writeStream.foreachBatch(lambda df, _: merge_batch(df, store, parse, now())).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_builds(
    spark: SparkSession, landing: str, documents: str, state_folder: str, docs_folder: str, base_url: str, checkpoint: str, sources: DataFrame, inputs: build.Inputs, now: Callable[[], datetime], **how
) -> StreamingQuery:
    """The whole flow for all documents (DOCUMENTS, Parquet) that have come into landing since the last time: discovery to publishing, a build a batch, then stop.

    A batch first goes into the store of documents, which looks up by address, so that a build reads
    what it asks for and not all there ever was. Both steps say the same when they are done again: a
    document takes its own place, and a build finds what an earlier attempt has put in force, delivers
    what that one owed, and adds nothing twice. inputs gives what isn't fetched, and get, if there is
    a fetcher; documents that land later are found by the builds of their batch.
    """
    kept = DocumentStore(spark, documents)

    def take(batch: DataFrame, _: int) -> None:
        kept.add(batch.select(*DOCUMENTS.names))
        fetcher = inputs.fetcher or Stored(kept)
        build.run(spark, sources, replace(inputs, documents=spark.createDataFrame([], DOCUMENTS), fetcher=fetcher), state_folder, docs_folder, base_url, now(), **how)

    stream = spark.readStream.schema(DOCUMENTS).parquet(landing)
    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Stored:
    """What a Fetcher is, without asking anyone: of the wanted documents those that a store has."""

    def __init__(self, store: DocumentStore):
        self.store = store

    def __call__(self, wanted: DataFrame, documents: DataFrame) -> DataFrame:
        return documents.unionByName(self.store.lookup(wanted.select("url", "kind").distinct()))
