"""The contract queries of the operators: each gets its rows through its operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm import ball_clusters, decontamination, fill_middle, kneser_ney, line_dedup, metric_search, ngram_join, packing, quality_model, quality_rules, sharding, token_files, toxicity
from harvestry.llm.samples import fold


def tokenizer_path() -> str:
    """Where the installed public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(F.col("id").alias("doc_id"), (fold(F.col("id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    remainder = fold(F.col("doc_id"), 10)
    model = kneser_ney.train(docs.filter(remainder != 0))
    out = kneser_ney.score(docs, model)
    return out.select(
        F.col("id").alias("doc_id"), (fold(F.col("id"), 10) == 0).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), distinct=True)
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from harvestry.scratch import new_folder

    manifest = token_files.write_corpus(_table(spark, sf_dir, "documents"), tokenizer_path(), new_folder(spark, "tokens"))
    return token_files.read_corpus(spark, manifest).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_model.train(docs, _table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).select(F.col("id").alias("doc_id"), (fold(F.col("id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign_shards(_table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contaminated(docs, _table(spark, sf_dir, "benchmark"))
    ids = docs.select("doc_id", F.xxhash64("text").alias("h"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("body_hash"))
    return ids.join(found, same, "left").select("doc_id", F.col("items").isNotNull().alias("contaminated"), "items", "coverage")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.transform(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return out.select(
        "row.doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), sha(F.col("output")).alias("output_sha256"), sha(back).alias("restored_sha256")
    )


def op12_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return metric_search.top_k(rows, rows.filter("vec_id % 50 = 0"), 5).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_ball_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ball_clusters.cluster(_table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.col("centroid").cast("binary"), 256).alias("centroid_sha256"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_quality_rules, op2_toxicity, op3_lm_scoring, op4_line_dedup, op5_token_files, op6_quality_model, op7_packing, op8_sharding, op9_ngram_join, op10_decontamination, op11_fill_middle, op12_metric_search, op13_ball_clusters)}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT k.*, (h.key IS NOT NULL AND k.doc_id < h.keeper) AS gone FROM k LEFT JOIN h ON k.key = h.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT x AS doc_id, x AS root FROM e UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id WHERE r.root < e.y)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY 1) m ON m.doc_id = d.doc_id
"""


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
u AS (SELECT *, length(t) AS n, [('0x' || substr(h, 1 + 8 * i, 8))::BIGINT for i in [0, 1, 2, 3]] AS hs FROM d),
c AS (SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR hs[3] % 100 >= 90 THEN 'plain'
           WHEN hs[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

_FINITE = "vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP12_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE {_FINITE}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def _op13_sql(rounds: int = 3) -> str:
    """k-means as a chain of tables: c0 .. are the centroids, a0 .. what is assigned to them."""
    steps = [
        f"v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings WHERE len(embedding) = 64 AND {_FINITE})",
        "c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1)::INTEGER AS cluster, v AS c FROM v QUALIFY cluster < 16)",
    ]
    for r in range(rounds + 1):
        steps.append(f"d{r} AS MATERIALIZED (SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance FROM v, c{r})")
        steps.append(f"a{r} AS MATERIALIZED (SELECT * FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)")
        if r < rounds:
            steps.append(f"e{r} AS (SELECT cluster, i, floor(sum(v[i]) / count(*)) AS m FROM a{r}, range(1, 65) AS t(i) GROUP BY cluster, i)")
            steps.append(f"m{r} AS (SELECT cluster, list(m ORDER BY i) AS m FROM e{r} GROUP BY cluster)")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m, c) AS c FROM c{r} LEFT JOIN m{r} ON c{r}.cluster = m{r}.cluster)")
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a{rounds}.cluster, distance, (sum(distance) OVER (PARTITION BY a{rounds}.cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON a{rounds}.cluster = c{rounds}.cluster"""
    )


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": OP4_SQL, "op9_ngram_join": OP9_SQL, "op11_fill_middle": OP11_SQL, "op12_metric_search": OP12_SQL, "op13_ball_clusters": _op13_sql()}
