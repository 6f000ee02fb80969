import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from harvestry.llm import line_dedup, quality_rules, queries, sharding

SPACES = " \t\n\x0b\x0c\r"


def words_of(t):
    return (t or "").encode().split()


def base(t):
    w = words_of(t)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(w) < 3000 else None
    lines = [x for x in (t or "").split("\n") if x.strip(SPACES)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t or ""), dup, covered and len(covered)


def test_statistics_against_brute_force(table, odd):
    r = random.Random(3)
    texts = [" ".join(r.choice("ab c# d$ é |".split()) for _ in range(r.randrange(60))) + "\n" * r.randrange(3) + "x\nx" * r.randrange(2) for _ in range(60)]
    rows = [*odd, *((100 + i, t) for i, t in enumerate(texts))]
    got = {(r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines): r.n_repeat_words for r in quality_rules.text_statistics(table(rows)).collect()}
    for i, t in rows:
        n, chars, symbols, dup, repeated = base(t)
        assert got[(i, n, chars, symbols, dup)] == (repeated or 0) or repeated is None


def test_rules_find_the_planted_thresholds(spark, table, prose):
    rows = [(i, prose(i, 80)) for i in range(200)] + [(1000 + i, " ".join(w + "###" for w in prose(i, 80).split())) for i in range(80)]
    docs = table([*rows, (None, "x"), (5000, None)])
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in rows] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    out = quality_rules.apply_rules(docs, labels).collect()
    assert len(out) == len(rows) + 2
    for r in out:
        if r.doc_id is not None and r.doc_id < 1000:
            assert r.kept and not r.base_failed
        elif r.doc_id is not None and r.doc_id < 5000:
            assert not r.kept and r.rule is not None
        else:
            assert r.base_failed and not r.kept


def test_no_labels_no_rules(spark, table, odd):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    out = quality_rules.apply_rules(table(odd), none)
    assert out.count() == len(odd) and out.filter("rule is not null").count() == 0
    assert quality_rules.apply_rules(table([]), none).count() == 0


def test_rules_are_native(table):
    plan = quality_rules.text_statistics(table([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def deduped(rows, chars=20, docs=3):
    def key(x):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(SPACES))

    held = {}
    for n, (i, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            if i is not None and len(k) >= chars:
                held.setdefault(k, []).append(i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        rest = [x for x in lines if i is None or key(x) not in gone or i >= gone[key(x)]]
        out.append((i, len(lines), len(lines) - len(rest), "\n".join(rest)))
    return out


def test_line_dedup_against_brute_force(table, odd):
    r = random.Random(1)
    pool = [f"A line that is said {x} often enough" for x in "abcdef"] + ["short", "", "  A LINE that is said a often enough\t", "Ünique line that is long"]
    rows = [*odd, *((100 + i, "\n".join(r.choice(pool) for _ in range(r.randrange(9)))) for i in range(60))]
    docs = table(rows)
    out = line_dedup.dedup_lines(docs)
    assert out.select("row.*").columns == docs.columns
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    got = sorted(((x.row.doc_id, x.n_lines, x.n_dropped, x.kept) for x in out.collect()), key=key)
    assert got == sorted(deduped(rows), key=key)
    assert line_dedup.dedup_lines(table([])).count() == 0


def test_line_dedup_query_counts_distinct_documents(spark, table, tmp_path):
    same, other = "one line that is long enough for this", "another line that is long enough too"
    rows = [(5, same), (6, same), (6, same), (7, other), (8, f"{other}\nx"), (8, other), (9, f"{same[::-1]}\n{other}"), (None, same), (None, same)]
    table(rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    held = {}
    for i, t in rows:
        for line in t.split("\n"):
            held.setdefault(line, set()).add(i)
    keeper = {x: max(ids) for x, ids in ((x, ids - {None}) for x, ids in held.items()) if len(x) >= 20 and len(ids) >= 3}
    assert set(keeper) == {other}
    want = sorted((i or 0, sum(x in keeper and i is not None and i < keeper[x] for x in t.split("\n"))) for i, t in rows)
    assert sorted((r.doc_id or 0, r.n_dropped) for r in queries.op4_line_dedup(spark, str(tmp_path)).collect()) == want
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet' WHERE doc_id IS NOT NULL")
    gone = dict(sql.execute(f"SELECT doc_id, n_dropped FROM ({queries.OP4_SQL})").fetchall())
    assert gone == {i: sum(n for j, n in want if j == i) for i, _ in rows if i is not None}
    piped = corpus_pipeline.without_repeated_lines(spark, table(rows), str(tmp_path)).collect()
    assert [r.text for r in piped if r.doc_id == 5] == [same]


def test_shards(table, odd):
    rows = [*odd, *((i, f"t{i}") for i in range(10, 400))]
    out = sharding.assign_shards(table(rows), 8).collect()
    assert len(out) == len(rows)
    slots = {}
    for x in out:
        slots.setdefault(x.shard, []).append(x.slot)
        assert x.grown_shard in (x.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    by = {x.doc_id: x for x in out if x.doc_id is not None}
    assert by[8].size == len(dict(rows)[8].encode()) + 8 and by[8].text_crc32 == zlib.crc32(dict(rows)[8].encode())
    assert by[1].size == 8 and by[1].text_crc32 == 0
    assert sum(x.grown_shard == 8 for x in out) < len(out) / 4
    assert len({x.shard for x in out if x.doc_id is None}) == 1
    assert sharding.assign_shards(table([]), 4).count() == 0


def test_shard_weights(spark, one):
    ids = spark.range(6000)
    counts = {r.s: r["count"] for r in ids.groupBy(sharding.rendezvous(F.col("id"), [1, 3, 0]).alias("s")).count().collect()}
    assert set(counts) == {0, 1} and 2.6 < counts[1] / counts[0] < 3.4
    for bad in ([], [0.0], [1, -1]):
        with pytest.raises(ValueError):
            sharding.rendezvous(F.col("id"), bad)
