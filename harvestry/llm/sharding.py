"""Rendezvous (highest random weight) sharding of record keys, in Spark expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestry.scratch import materialise

#: Seeds the score of a (shard, key) pair; changing it reshuffles every record.
SEED = 7919


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (index into weights) with the highest score -w / ln(u) for this key.

    u in (0, 1) is a hash of the key and the shard. Appending a shard leaves the scores of all
    others as they are, so records only ever move into the new one. A null key hashes as nothing
    but the shard, so all null keys share one shard. Shards of weight 0 get no records.
    """
    if not weights or min(weights) < 0 or not any(weights):
        raise ValueError("weights need at least one positive number and no negative one")
    scores = []
    for shard, weight in enumerate(weights):
        if not weight:
            continue
        # 52 bits, so that the fraction is exact and never 0 or 1
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.lit(shard), key), 12).cast("double")
        u = (bits + 0.5) / F.lit(float(2**52))
        scores.append(F.struct((-F.log(u) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard")))
    best = F.least(*scores) if len(scores) > 1 else scores[0]
    return best["shard"]


def assign_shards(docs: DataFrame, shards: int | list[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, shard, grown_shard, slot.

    shards is a count, or a list of weights. size is the UTF-8 length of the text plus 8 (null
    text: 8, and the checksum of no bytes, 0). grown_shard is the shard after one more of the mean
    weight is added. slot numbers the rows of a shard without gaps: rows are numbered inside
    (shard, scan partition), whose size the scan bounds, and the sizes of these groups are summed
    from a small table, so that no shard is ever sorted as a whole and a hot key is no hot task.
    Equal keys, null ones included, share a shard; repeated rows get slots of their own; an empty
    table gives an empty result. Only the key and the text are read, so other columns never clash.
    """
    weights = [1.0] * shards if isinstance(shards, int) else [float(w) for w in shards]
    mean = math.fsum(weights) / len(weights)
    base = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    slim = base.select(
        "key",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        rendezvous(F.col("key"), weights).cast("int").alias("shard"),
        rendezvous(F.col("key"), [*weights, mean]).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("rid"),
    )
    # written, so that a part that is computed again can't number its rows anew
    slim = materialise(slim, "shards")
    rid, part, shard = F.col("rid"), F.col("part"), F.col("shard")
    from pyspark.sql import Window

    sizes = slim.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard.alias("s"), part.alias("p"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "part").orderBy(rid)
    numbered = slim.withColumn("n", F.row_number().over(within) - 1)
    return numbered.join(starts, (shard == F.col("s")) & (part == F.col("p"))).select(
        F.col("key").alias(key), "size", "text_crc32", "shard", "grown_shard", (F.col("first") + F.col("n")).cast(T.LongType()).alias("slot")
    )
