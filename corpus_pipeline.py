"""The corpus pipeline: five operators, one after the other, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir), and its result is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from harvestry.llm.queries import tokenizer_path
from harvestry.llm.samples import free_names
from harvestry.scratch import materialise

#: SQL can't express the learned first stage.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model learned from the labels among them scores under one half.

    Null and empty texts score as the model's bias says; repeated rows share a verdict; all columns
    stay, whatever their names; no documents give none.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows the text.

    A null text stays null, a null id counts for no line and keeps all its own, repeated rows of an
    id are one document. Columns of any name stay as they are.
    """
    out = line_dedup.dedup_lines(docs, distinct=True)
    columns = []
    for c in docs.columns:
        old = F.col(f"row.`{c}`")
        if c == "text":
            old = F.when(old.isNull() & (F.col("n_dropped") == 0), old).otherwise(F.col("kept"))
        elif c == "n_chars":
            old = F.when(F.col("n_dropped") > 0, F.length("kept").cast("long")).otherwise(old).cast(docs.schema[c].dataType)
        columns.append(old.alias(c))
    return out.select(*columns)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the least id (null comes last), of its rows that of the least hash of the text.

    Rows are compared, not ids: repeated rows and those with a null id are copies like others, and
    of an id with many texts only those go that have a copy that stays. Texts without words stay.
    Columns of any name stay as they are.
    """
    (row,) = free_names(docs, "row")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), row)
    groups = ngram_join.similar_documents(rows, key=row).select(F.col(row).alias("a"), "component_id")
    ranked = groups.join(rows.select(F.col(row).alias("b"), rank.alias("rank")), F.col("a") == F.col("b"))
    kept = ranked.groupBy("component_id").agg(F.min("rank").alias("first")).select(F.col("first")[row].alias("kept"))
    (mine,) = free_names(rows, "kept")
    kept = kept.select(F.col("kept").alias(mine))
    return rows.join(kept.hint("shuffle_hash"), F.col(row) == F.col(mine), "left_semi").drop(row)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; repeated rows share a verdict, also with a null id. Columns of
    any name stay as they are.
    """
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, each with its sequence and its place there; a null text is its end alone."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", one_of_similar),
    ("benchmark_decontamination", without_benchmark),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
