"""Corpus-wide removal of repeated lines: explode, hash, count documents, drop, reassemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.scratch import materialise

#: A-Z to lower case and nothing else, as the key is defined on ASCII case only.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space [\\x20\\x09-\\x0D] at both ends, A-Z in lower case."""
    return F.translate(F.trim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, key: str = "doc_id", text: str = "text", distinct: bool = False) -> DataFrame:
    """row (a struct of all columns of docs), n_lines long, n_dropped long and kept string, a row for each of docs.

    A line whose key has at least min_chars code points and occurs in at least min_docs rows is
    dropped, except from the rows with the largest id that hold it; all its occurrences go or stay
    together. A null or empty text is one empty line and stays "". With distinct, as the query and
    the pipeline have it, an id is a document, however many rows it has; without, each input row is
    one and repeated rows count each. Rows with a null id are left as they are and not counted.
    Columns of docs stay inside row, so that none can clash, whatever its name.

    Texts are split once: the hashes (128 bits), ids and positions of long enough lines are
    written, and both the count, with map-side sums, and the join back read them; that join is one
    that adaptive execution splits at a hot line. The texts move once, to meet the positions to drop.
    """
    doc = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    body = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    doc = doc.select("row", F.col(f"row.`{key}`").alias("id"), F.xxhash64(body).alias("h"))
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).filter("id is not null")
    # rows of one id and text are told apart only for counting
    lines = (
        texts.select("id", F.xxhash64("t").alias("h"), *([] if distinct else [F.monotonically_increasing_id().alias("nth")]), F.posexplode(F.split("t", "\n")).alias("pos", "line"))
        .filter(F.length("line") >= min_chars)
        .withColumn("k", line_key(F.col("line")))
        .filter(F.length("k") >= min_chars)
        .select("id", "h", *([] if distinct else ["nth"]), "pos", F.xxhash64("k").alias("a"), F.xxhash64(F.lit(31), "k").alias("b"))
    )
    lines = materialise(lines, "lines")
    holders = lines.select("a", "b", "id", *([] if distinct else ["nth"])).distinct()
    held = holders.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper")).filter(F.col("n") >= min_docs).select("a", "b", "keeper")
    # written first, so that the join reads plain exchanges, which adaptive execution can split
    held = materialise(held, "held")
    drops = (
        lines.join(held, ["a", "b"])
        .filter(F.col("id") < F.col("keeper"))
        .groupBy(F.col("id").alias("i"), F.col("h").alias("g"))
        .agg(F.collect_set("pos").alias("drop"))
    )
    met = doc.join(drops.hint("shuffle_hash"), (F.col("id") == F.col("i")) & (F.col("h") == F.col("g")), "left")
    split = F.split(body, "\n")

    def rest(lines: Column) -> Column:
        keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drop"))
        return F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")

    # the one-element array binds the split text to a name, so that it is split once a row
    kept = F.when(F.col("drop").isNull(), body).otherwise(F.get(F.transform(F.array(split), rest), F.lit(0)))
    return met.select("row", F.size(split).cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
