"""Connected components of an edge table by alternating star contractions, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.scratch import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge (a, b), null-free: root is the least node reachable.

    Each round hangs a node's greater neighbours on its least one, then its lesser ones. Rounds
    grow with the logarithm of the longest path; each is written, so a lost executor costs one.
    A node with very many neighbours is summed map-side and its join is one that adaptive execution
    splits. No edges give no rows.
    """

    def tidy(e: DataFrame) -> DataFrame:
        return e.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    now, before = materialise(tidy(edges), "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit((1 << 31) - 1)))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        before = mark
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
        large = tidy(both.join(least, F.col("u") == F.col("w")).filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")))
        large = materialise(large, "large")
        lower = large.groupBy(F.col("b").alias("w")).agg(F.min("a").alias("m"))
        small = large.join(lower, F.col("b") == F.col("w")).select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        now = materialise(tidy(small.select(F.col("x").alias("a"), F.col("y").alias("b"))), "edges")
