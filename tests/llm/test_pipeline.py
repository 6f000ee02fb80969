import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from harvestry.llm import packing, toxicity  # noqa: E402
from tests.llm.test_copies import brute, near  # noqa: E402
from tests.llm.test_text_rules import deduped  # noqa: E402
from tests.llm.test_tokens import library  # noqa: E402

ITEM = "A careful reader copies seven silver keys into the blue drawer before noon and counts them twice again"


@pytest.fixture(scope="module")
def folder(spark, prose, tmp_path_factory):
    r = random.Random(6)
    out = tmp_path_factory.mktemp("sf")
    line = "This very line is shared by a good many of the documents"
    rows, labels = [], []
    for i in range(400):
        text = prose(3000 + i, 60 + i % 40)
        toxic = i % 8 == 0
        if toxic:
            text = "vile " + text + " grim nasty"
        elif i % 8 == 1 and i > 8:
            text = near(r, prose(3000 + 2, 62), i % 3) if i % 16 == 1 else text + " " + ITEM + " " + prose(i, 5)
        elif i % 8 == 3:
            text = f"{line}\n{text}"
        rows.append((i, text, "en", f"s{i % 3}", len(text), float(i)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, 1, int(toxic)))
    rows += [(900, None, None, None, None, None), (901, "", "en", "s", 0, None), (None, "no id at all", "en", "s", 12, 1.0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_each_stage_against_brute_force(spark, folder, vocabulary):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    before = pairs(docs)

    def go(name, docs):
        out = stages[name](spark, docs, folder)
        return out if name == "best_fit_packing" else spark.createDataFrame(out.collect(), docs.schema)

    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    docs = go("toxicity", docs)
    assert docs.columns == columns
    assert pairs(docs) == [(i, t) for i, t in before if model.score(t.encode() if t is not None else None) < 0.5]
    assert {i for i, _ in before} - {i for i, _ in pairs(docs)} == {i for i in range(0, 400, 8)}

    before = pairs(docs)
    docs = go("line_dedup", docs)
    want = sorted(((i, None if t is None else kept) for (i, t), (_, _, _, kept) in zip(before, deduped(before), strict=True)), key=str)
    assert docs.columns == columns and pairs(docs) == want and before != want
    assert all(r.n_chars == len(r.text) for r in docs.filter("text is not null").collect())

    before = pairs(docs)
    docs = go("ngram_jaccard_join", docs)
    keep = {i for _, i, _, c in brute(before) if i == c}
    assert docs.columns == columns and pairs(docs) == [(i, t) for i, t in before if i is None or i in keep] and len(before) > docs.count()

    before = pairs(docs)
    docs = go("benchmark_decontamination", docs)
    assert docs.columns == columns and pairs(docs) == [(i, t) for i, t in before if ITEM not in (t or "")] and len(before) > docs.count()

    before = pairs(docs)
    got = go("best_fit_packing", docs).collect()
    sizes = sorted((i or -1, len(library(vocabulary, t)) + 1) for i, t in before)
    assert sorted((r.doc_id or -1, r.length) for r in got) == sizes
    assert len({r.sequence_id for r in got}) == len(packing.best_fit([n for _, n in sizes], packing.CAPACITY))


def test_one_row_of_similar_stays(spark, folder, table, prose):
    r = random.Random(4)
    a, b, c, d = (prose(7000 + k, 90) for k in range(4))
    rows = [(1, a), (1, a), (2, near(r, a, 1)), (None, a), (None, b), (None, b), (None, near(r, b, 1)), (5, c), (5, near(r, d, 1)), (4, d), (6, c), (7, ""), (8, None), (None, None)]
    out = pairs(corpus_pipeline.one_of_similar(spark, table(rows), folder))
    nulls = [x for x in out if x[0] is None and x[1]]
    assert len(nulls) == 1 and nulls[0] in rows[4:7]
    assert [x for x in out if x not in nulls] == sorted([(1, a), (5, c), (4, d), (7, ""), (8, None), (None, None)], key=str)
    again = pairs(corpus_pipeline.one_of_similar(spark, table(rows[::-1]), folder))
    assert again == out


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 0
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
