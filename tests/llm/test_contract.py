"""The ten queries as they are registered: their columns and what holds for every row; odd tables and clashing names."""

import os
import zlib

import pytest

from harvestry.llm import decontamination, kneser_ney, line_dedup, ngram_join, packing, quality_model, quality_rules, queries, sharding, token_files, toxicity
from harvestry.scratch import new_folder

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables aren't here")

COLUMNS = {
    "op1_quality_rules": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint base_failed:boolean kept:boolean",
    "op2_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op3_lm_scoring": "doc_id:bigint held_out:boolean n_tokens:bigint n_known:bigint train_tokens:bigint base_score:double score:double",
    "op4_line_dedup": "doc_id:bigint n_lines:bigint n_dropped:bigint kept_sha256:string",
    "op5_token_files": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint",
    "op6_quality_model": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op7_packing": "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint",
    "op8_sharding": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op9_ngram_join": "doc_id:bigint n_shingles:bigint component_id:bigint",
}


@needs_tables
@pytest.mark.parametrize("name", [*COLUMNS, "op10_decontamination"])
def test_query(spark, name):
    out = queries.queries()[name](spark, SF)
    rows = [r.asDict() for r in out.collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    types = dict(out.dtypes)
    for column, kind in (x.split(":") for x in COLUMNS.get(name, "doc_id:bigint contaminated:boolean").split()):
        assert types[column] == kind, column
    # in the contract's order
    wanted = [x.split(":")[0] for x in COLUMNS.get(name, "doc_id:bigint").split()]
    assert [c for c in out.columns if c in wanted] == wanted
    ids = [r["doc_id"] for r in rows]
    assert set(ids) == set(texts) and (name == "op7_packing" or len(ids) == len(texts))
    crc = lambda i, n: zlib.crc32(str(i).encode()) % n
    if "held_out" in types:
        n, held = {"op2_toxicity": (5, 0), "op3_lm_scoring": (10, 0), "op6_quality_model": (3, 1)}[name]
        assert all(r["held_out"] == (crc(r["doc_id"], n) == held) for r in rows)
    if "predicted" in types:
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    if name == "op1_quality_rules":
        assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in rows)
    if name == "op3_lm_scoring":
        train = sum(len((t or "").encode().split()) + 1 for i, t in texts.items() if crc(i, 10))
        assert {r["train_tokens"] for r in rows} == {train}
        assert all(r["n_tokens"] == len((texts[r["doc_id"]] or "").encode().split()) + 1 for r in rows)
        held = [r for r in rows if r["held_out"]]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    if name == "op5_token_files":
        at = 0
        for r in sorted(rows, key=lambda r: r["doc_id"]):
            assert r["start"] == at
            at += r["n_tokens"]
    if name == "op7_packing":
        bins, pieces = {}, {}
        for r in rows:
            bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
            pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
        for places in bins.values():
            places.sort()
            assert [p for p, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 4096
        for own in pieces.values():
            own.sort()
            assert [x[:2] for x in own] == [(k, 4096 * k) for k in range(len(own))] and all(n == 4096 for _, _, n in own[:-1])
    if name == "op8_sharding":
        shards = {}
        for r in rows:
            text = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"], r["law"]) == (len(text) + 8, zlib.crc32(text), "key") and r["grown_shard"] in (r["shard"], 24)
            shards.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    if name == "op9_ngram_join":
        assert all(r["component_id"] <= r["doc_id"] for r in rows)


#: Names that operators have used or use inside.
CLASHING = "id row kept body body_hash h g i drop n rank kind sid did wid wh hash _id __id __row __kept __lines __dropped __hash component_id n_shingles sequence_id members shard key t ids pos line lines items size".split()


def test_clashing_columns(spark, vocabulary, odd):
    from pyspark.sql import functions as F

    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.createDataFrame([(i, t) for i, t in odd], "doc_id bigint, text string").select("*", F.lit("en").alias("lang"), *[F.lit(7).alias(c) for c in CLASHING])
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality bigint, toxic bigint")
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id bigint, text string")
    n = len(odd)
    assert quality_rules.apply_rules(docs, labels).count() == n
    assert toxicity.score(docs, toxicity.train(docs, labels)).count() == n
    assert quality_model.score(docs, quality_model.train(docs, labels)).count() == n
    assert kneser_ney.score(docs, kneser_ney.train(docs)).count() == n
    assert line_dedup.dedup_lines(docs).count() == n and line_dedup.dedup_lines(docs, distinct=True).select("row.__kept").count() == n
    assert token_files.read_corpus(spark, token_files.write_corpus(docs, vocabulary, new_folder(spark, "t"))).count() == n
    assert packing.pack_documents(docs, vocabulary).select("doc_id").distinct().count() == len({i for i, _ in odd})
    assert sharding.assign_shards(docs, 3).count() == n
    assert ngram_join.similar_documents(docs).count() == n
    assert decontamination.decontaminate(docs, items).columns == docs.columns
    folder = new_folder(spark, "sf")
    labels.write.parquet(f"{folder}/labels.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_conflicting_labels_teach_nothing(spark, table, prose):
    from harvestry.llm.samples import agreed, sample_texts

    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (2, 1), (3, None), (3, 1), (None, 1), (4, 7)], "doc_id bigint, toxic int")
    assert sorted((r.sid, r.y) for r in agreed(labels, "toxic").collect()) == [(1, 0), (3, 1)]
    # a bound on bytes takes whole texts, in an order of its own, and one row an id
    docs = table([(i, "x" * 100) for i in range(50)] + [(7, "y" * 90)] * 20)
    chosen = spark.createDataFrame([(i, i % 2) for i in range(50)], "sid bigint, kind int")
    all_of = sample_texts(docs, chosen)
    assert all_of.num_rows == 50
    some = sample_texts(docs, chosen, max_bytes=1000)
    assert 9 <= some.num_rows <= 11 and some.to_pylist() == sample_texts(docs.repartition(7), chosen, max_bytes=1000).to_pylist()
