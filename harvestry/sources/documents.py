"""A store of fetched documents that is looked up by address: texts and bytes apart, clustered by the address's hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.sinks.store import Store
from harvestry.sources.schemas import DOCUMENTS, TEXTS, CONTENTS

_KINDS = {"text": ("texts", "body"), "bytes": ("contents", "bytes")}


class DocumentStore:
    """Fetched documents, one of each (url, kind), in two keyed tables with buckets, sorted addresses and Bloom filters.

    A look-up opens the files of the buckets that its addresses are in, and of each kind only those:
    asking for a page never reads an image. What add() has written counts when all of it is there.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark = spark
        self.store = Store(spark, folder, {"texts": TEXTS, "contents": CONTENTS}, buckets, key="url")

    def _as_documents(self, kind: str, rows: DataFrame) -> DataFrame:
        column = _KINDS[kind][1]
        other = "bytes" if column == "body" else "body"
        none = F.lit(None).cast(DOCUMENTS[other].dataType).alias(other)
        return rows.select("url", F.lit(kind).alias("kind"), column, none, F.lit(True).alias("ok")).select(*DOCUMENTS.names)

    def documents(self) -> DataFrame:
        """All of them."""
        return self._as_documents("text", self.store.read("texts")).unionByName(self._as_documents("bytes", self.store.read("contents")))

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Those of wanted (url, kind) that are there, as DOCUMENTS."""
        out = None
        for kind, (table, _) in _KINDS.items():
            rows = self._as_documents(kind, self.store.rows_of(table, wanted.filter(F.col("kind") == kind)))
            out = rows if out is None else out.unionByName(rows)
        return out

    def add(self, documents: DataFrame) -> None:
        """Keep the ok ones of DOCUMENTS; of several of one (url, kind) one, and one that comes again takes the old one's place."""
        changes = {}
        for kind, (table, column) in _KINDS.items():
            rows = documents.filter(F.col("ok") & (F.col("kind") == kind) & F.col(column).isNotNull() & F.col("url").isNotNull())
            changes[table] = rows.select("url", column).dropDuplicates(["url"])
        self.store.commit(changes)
        self.store.compact_if_due()
