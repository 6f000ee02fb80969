"""Folds, bounded samples and free column names that the operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a sample brings to the driver at most; rows beyond it, in the sample's order, are left out.
MAX_SAMPLE_BYTES = 96 << 20


def fold(key: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id has remainder -1 and so never trains."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(n)), F.lit(-1))


def bounded(ids: DataFrame, most: int) -> DataFrame:
    """At most `most` of the ids (column sid), the ones of smallest hash: the same at every run."""
    return ids.orderBy(F.xxhash64("sid"), "sid").limit(most)


def agreed(labels: DataFrame, label: str) -> DataFrame:
    """(sid, y int): the ids whose rows all have one and the same label of 0 or 1; null ids and labels are left out."""
    known = labels.select(F.col("doc_id").alias("sid"), F.col(label).cast("int").alias("y")).filter("sid is not null and y in (0, 1)")
    return known.groupBy("sid").agg(F.min("y").alias("y"), F.max("y").alias("top")).filter("y = top").drop("top")


def sample_texts(docs: DataFrame, chosen: DataFrame, max_bytes: int = MAX_SAMPLE_BYTES) -> pa.Table:
    """(kind, sid, body) of the chosen (sid, kind), whose number the caller has bounded: one row each.

    Of an id with many texts the one of least hash is taken. The sizes come first and say which
    texts may come at all, so neither an id with very many rows nor very long texts can flood the
    driver.
    """
    texts = docs.select(F.col("doc_id").alias("did"), F.col("text").cast("binary").alias("body"), F.xxhash64("text").alias("h")).filter("did is not null and body is not null")
    small = F.broadcast(chosen)
    sizes = texts.join(small, F.col("did") == F.col("sid")).groupBy("sid", "kind").agg(F.min(F.struct("h", F.octet_length("body").alias("size"))).alias("pick"))
    rows = sizes.select(F.xxhash64("sid").alias("place"), "sid", "kind", "pick.h", "pick.size").collect()
    taken, used = {}, 0
    for _, sid, kind, h, size in sorted(map(tuple, rows)):
        if (sid, h) in taken:
            taken[sid, h].append(kind)
        elif used + size <= max_bytes:
            used += size
            taken[sid, h] = [kind]
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(sid, h) for sid, h in taken], "wid long, wh long")  # at most the rows of chosen
    found = texts.join(F.broadcast(wanted), (F.col("did") == F.col("wid")) & (F.col("h") == F.col("wh"))).groupBy("wid", "wh").agg(F.first("body").alias("body")).toArrow()
    out = sorted((kind, sid, body) for sid, h, body in zip(*(c.to_pylist() for c in found.columns), strict=True) for kind in taken[sid, h])
    return pa.table({"kind": pa.array([r[0] for r in out], pa.int32()), "sid": pa.array([r[1] for r in out], pa.int64()), "body": pa.array([r[2] for r in out], pa.binary())})


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores before it as no column of docs has."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
