"""Versioned Parquet snapshots, and the catalog as one JSON document."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestry.scratch import materialise
from harvestry.sources.schemas import CATALOG, conform


class Snapshots:
    """A table under a folder: v=1, v=2 .. each written whole; the greatest complete one is in force.

    A table can't be overwritten while it is read, so every write makes a new version. It counts
    from the moment its _SUCCESS is there, the last thing a write makes: a write that stops before
    leaves the one before it in force, and its number is never used again. The KEPT newest
    versions stay. A missing table is an empty one.
    """

    KEPT = 3

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType = CATALOG, partition_by: tuple[str, ...] = ()):
        self.spark, self.folder, self.schema, self.partition_by = spark, folder.rstrip("/"), schema, partition_by
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[tuple[int, bool]]:
        """(number, whether it is complete) of what is there, ascending."""
        where = self._path(self.folder)
        names = [str(f.getPath().getName()) for f in self._fs.listStatus(where)] if self._fs.exists(where) else []
        numbers = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
        return [(n, self._fs.exists(self._path(f"{self.folder}/v={n}/_SUCCESS"))) for n in numbers]

    def version(self) -> int:
        return max((n for n, complete in self._versions() if complete), default=0)

    def read(self) -> DataFrame:
        now = self.version()
        if not now:
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).parquet(f"{self.folder}/v={now}")
        return conform(found, self.schema) if self.schema is CATALOG else found.select(*self.schema.names)

    def write(self, df: DataFrame) -> DataFrame:
        """Write the next version and return it as read back."""
        n = max((n for n, _ in self._versions()), default=0) + 1
        out = df.select(*self.schema.names).write
        (out.partitionBy(*self.partition_by) if self.partition_by else out).parquet(f"{self.folder}/v={n}")
        for old, _ in [v for v in self._versions() if v[1]][: -self.KEPT]:
            self._fs.delete(self._path(f"{self.folder}/v={old}"), True)
        return self.read()


def catalog_lines(catalog: DataFrame, failures: DataFrame, now: datetime, version: int = 1) -> DataFrame:
    """(part, seq, line): the lines of one JSON document {version, generated_at, count, recipes, failures}, in order.

    Records and failures are keyed by their dedup_key, a line each; every line but a part's first starts with
    the comma that ends the one before it, so no line has to know which is the last.
    """
    spark = catalog.sparkSession
    entry = lambda key, columns: F.concat(_quoted(key), F.lit(": "), F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    first = lambda column, least: F.when(F.col(column).eqNullSafe(F.lit(least)), F.lit("")).otherwise(F.lit(","))
    top = catalog.agg(F.count(F.lit(1)), F.min("seq")).first()
    least = failures.agg(F.min("dedup_key")).first()[0]
    records = catalog.select(F.lit(1).alias("part"), "seq", F.lit("").alias("key"), F.concat(first("seq", top[1]), entry(F.col("dedup_key"), [c for c in catalog.columns if c != "seq"])).alias("line"))
    failed = failures.select(F.lit(3).alias("part"), F.lit(None).cast("bigint").alias("seq"), F.col("dedup_key").alias("key"), F.concat(first("dedup_key", least), entry(F.col("dedup_key"), failures.columns)).alias("line"))
    head = f'{{"version": {version}, "generated_at": "{now.isoformat()}", "count": {top[0]}, "recipes": {{'
    frame = spark.createDataFrame([(0, None, "", head), (2, None, "", '}, "failures": {'), (4, None, "", "}}")], "part int, seq bigint, key string, line string")
    return frame.unionByName(records).unionByName(failed).select("part", "seq", "key", "line")


def _quoted(text) -> Column:
    """text as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("k"))), r'(?s)^\{"k":(.*)\}$', 1)


def write_document(lines: DataFrame, path: str) -> None:
    """One text file of ordered lines: sorted in ranges by many tasks, then streamed together, a block at a time."""
    spark = lines.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    lines.sort("part", "seq", "key").select("line").write.text(parts)
    fs = where(path).getFileSystem(conf)
    try:
        out = fs.create(where(f"{parts}/whole"), True)
        try:
            for name in sorted(str(f.getPath().getName()) for f in fs.listStatus(where(parts)) if str(f.getPath().getName()).startswith("part-")):
                part = fs.open(where(f"{parts}/{name}"))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                finally:
                    part.close()
        finally:
            out.close()
        # FileContext replaces what is there in one step
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where(path).toUri(), conf)
        how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(where(f"{parts}/whole"), where(path), how)
    finally:
        fs.delete(where(parts), True)


#: The lines that catalog_lines() writes: the head, what stands between records and failures, the end, and an entry once its strings are taken out.
_HEAD, _MIDDLE, _END = r'^\{"version": -?\d+, "generated_at": "[^"\\]*", "count": \d+, "recipes": \{\z', '}, "failures": {', "}}"
_STRING, _FLAT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', r"^,?: \{[^{}]*\}\z"


def import_json(spark: SparkSession, path: str) -> DataFrame:
    """A catalog from one JSON document {recipes: {key: record}}, in the order of the document.

    A document as write_document() makes it has a line for each record, and is read by lines: many
    tasks read its parts, and records are numbered by the places and sizes of these. Whether it is
    such a one is seen from all its lines. Any other JSON is parsed as one value, as big as a row can be.
    """
    record = T.StructType([f for f in CATALOG if f.name != "seq"]).simpleString()
    value = F.col("value")
    flat = F.regexp_replace(value, _STRING, "").rlike(_FLAT)
    kind = F.when(value.rlike(_HEAD), "head").when(value == _MIDDLE, "middle").when(value == _END, "end").when(flat & F.startswith(value, F.lit(",")), "next").when(flat, "first").otherwise("odd")
    entry = F.from_json(F.concat(F.lit("{"), F.regexp_replace(value, "^,", ""), F.lit("}")), f"map<string,{record}>")
    read = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"), kind.alias("kind"), F.when(flat, F.get(F.map_values(entry), F.lit(0))).alias("r"))
    read = materialise(read, "document")
    place = F.struct("at", "id")
    span = read.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least"), F.max(place).alias("most"), F.count_if(F.col("r").isNull()).alias("void"))
    found = {r["kind"]: r for r in span.collect()}  # six kinds
    marks = [found[k]["least"] for k in ("head", "middle", "end") if k in found and found[k]["n"] == 1]
    entries = [found[k] for k in ("first", "next") if k in found]
    own = len(marks) == 3 and "odd" not in found and marks == sorted(marks) and all(marks[0] < r["least"] and r["most"] < marks[2] and not r["void"] for r in entries)
    part = F.when(place < F.struct(F.lit(marks[1]["at"]).cast("bigint").alias("at"), F.lit(marks[1]["id"]).cast("bigint").alias("id")), 1).otherwise(2) if own else None
    if own:  # the first of each part, and no other one, has no comma before it
        starts = read.filter("kind in ('first', 'next')").groupBy(part.alias("part")).agg(F.min_by("kind", place).alias("kind"), F.count_if(F.col("kind") == "first").alias("n")).collect()
        own = all(r["kind"] == "first" and r["n"] == 1 for r in starts)
    if not own:
        raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"recipes map<string,{record}>").alias("d"))
        rows = raw.select(F.posexplode(F.map_values("d.recipes")).alias("seq", "r"))
        return conform(rows.select(F.col("seq").cast("bigint").alias("seq"), "r.*"))
    records = read.filter("kind in ('first', 'next')").filter(part == 1)
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sizes = records.groupBy("at").agg(F.count(F.lit(1)).alias("n"))  # a row a part of the file
    starts = sizes.select(F.col("at").alias("__at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    nth = F.row_number().over(Window.partitionBy("at").orderBy("id")) - 1
    rows = records.withColumn("__n", nth).join(F.broadcast(starts), F.col("at") == F.col("__at"))
    return conform(rows.select((F.col("__start") + F.col("__n")).cast("bigint").alias("seq"), "r.*"))
