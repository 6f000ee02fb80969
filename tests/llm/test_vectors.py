"""Exact search and clustering of vectors against plain loops."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harvestry.llm import ball_clusters, metric_search, queries, vectors

NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    """(vec_id, embedding) and columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, "x", 1, 2.0, 3) for i, v in rows], "vec_id bigint, embedding array<float>, id string, rank int, v double, cluster int")


def usable(v, dims=None):
    return v is not None and (dims is None or len(v) == dims) and all(x is not None and math.isfinite(x) for x in v)


def integers(v, scale):
    return [math.floor(scale * float(np.float32(x))) for x in v]


def plain_top(rows, queries_, k):
    """{query: [(rank, id, score)]}, a list of lists for repeated queries, by looking at all rows."""
    good = [(i, integers(v, 256)) for i, v in rows if i is not None and usable(v)]
    out = []
    for i, v in queries_:
        if i is None or not usable(v):
            continue
        q, rest = integers(v, 256), list(good)
        rest.remove((i, q))
        scored = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in rest)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def clustered(seed, n, dims=8, groups=6, spread=0.05):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dims))
    return [(i, [float(x) for x in centres[r.integers(groups)] + spread * r.normal(size=dims)]) for i in range(n)]


ODD = [
    (1000, None), (1001, [0.1, None, 0.3]), (1002, [NAN, 1.0, 2.0]), (1050, [INF, 1.0]), (None, [1.0, 2.0, 3.0]), (1100, []), (1150, [0.5]), (1101, [-0.5, -1e-9]),
    (1200, [0.0] * 8), (1250, [1.0] * 12), (1250, [1.0] * 12), (1300, [1.0] * 12), (1350, [-0.0039, 0.0] * 4),
]


@pytest.mark.parametrize("k", [1, 5])
def test_top_k_against_all_rows(spark, k):
    rows = clustered(1, 300) + ODD + [(2000 + i, [0.25] * 8) for i in range(120)]
    table = frame(spark, rows).repartition(3)
    asked = [(i, v) for i, v in rows if i is not None and i % 50 == 0]
    got = metric_search.top_k(table, frame(spark, asked), k, page=8, tree_rows=64)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == plain_top(rows, asked, k)
    # a block a job, as few queries as may be
    some = metric_search.top_k(table, frame(spark, asked), k, block_bytes=600)
    assert sorted(map(tuple, some.collect())) == plain_top(rows, asked, k)


def test_few_rows_and_none(spark):
    rows = [(50, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [3.0])]
    assert sorted(map(tuple, metric_search.top_k(frame(spark, rows), frame(spark, rows[:1]), 5).collect())) == plain_top(rows, rows[:1], 5)
    none = frame(spark, rows).limit(0)
    assert metric_search.top_k(none, none, 5).count() == 0 and metric_search.top_k(frame(spark, rows), none, 5).count() == 0
    alone = frame(spark, rows[:1])
    assert metric_search.top_k(alone, alone, 5).count() == 0


def test_large_components_stay_exact(spark):
    r = random.Random(2)
    rows = [(i, [float(r.randrange(-400_000, 400_000)) for _ in range(6)]) for i in range(120)] + [(500, [1e30] * 6), (501, [3e6] * 6)]
    asked = [(i, v) for i, v in rows if i % 50 == 0 and i < 500]
    kept = [x for x in rows if x[0] < 501]
    got = metric_search.top_k(frame(spark, rows), frame(spark, asked), 5, page=8)
    assert sorted(map(tuple, got.collect())) == plain_top([x for x in kept if x[0] != 500], asked, 5)


def test_tree_holds_what_it_says():
    x = vectors.padded(np.floor(256 * np.array([v for _, v in clustered(3, 900)])).astype(np.int64), 8)
    pages = metric_search.grown(np.arange(len(x)), x, 10)

    def below(n):
        p = pages[n]
        return list(p.refs) if p.leaf else [j for c in p.refs for j in below(c)]

    def depth(n):
        return 1 if pages[n].leaf else 1 + depth(pages[n].refs[0])

    assert sorted(below(0)) == list(range(len(x))) and all(len(p.refs) <= 10 for p in pages)
    for p in pages:
        if p.leaf:
            continue
        assert len({depth(c) for c in p.refs}) == 1
        for entry, (c, radius, most) in enumerate(zip(p.refs, p.radius, p.most)):
            under = x[below(c)]
            own = np.linalg.norm(under - p.vectors[entry], axis=1)
            assert own.max() <= radius + 1e-6 and (under.astype(float) ** 2).sum(axis=1).max() <= most
            # the distances in the page below are to this very vector
            assert np.allclose(pages[c].apart, np.linalg.norm(pages[c].vectors - p.vectors[entry], axis=1))


def test_stored_bounds_spare_products():
    x = np.floor(256 * np.array([v for _, v in clustered(4, 5000, groups=40, spread=0.01)])).astype(np.int64)
    pages = metric_search._read(metric_search._stored(metric_search.grown(np.arange(len(x)), x, 32)), 8)
    did = metric_search.Searched()
    for q in x[::50]:
        found = []
        metric_search.search(pages, q, float(q @ q), found, 6, did)
        scores = x @ q
        assert sorted((-s, -i) for s, i in found) == sorted(zip((-scores).tolist(), range(len(x))))[:6]
    assert did.products < 0.5 * len(x) * 100 and did.products < did.entries


def test_chunks_and_packing():
    batch = pa.record_batch({"id": pa.array(range(10)), "v": pa.array([[i] * (1 + i % 3) for i in range(10)], pa.list_(pa.int32()))})
    got = list(vectors.chunks([batch, batch.slice(2, 5)], 4, 1 << 20))
    assert [i for ids, _ in got for i in ids] == [*range(10), *range(2, 7)] and max(len(ids) for ids, _ in got) == 4
    for ids, x in got:
        for i, row in zip(ids, x):
            own = [i] * (1 + i % 3)
            assert row.tolist() == own + [0] * (x.shape[1] - len(own))
    assert all(len(ids) <= 2 for ids, _ in vectors.chunks([batch], 100, 24))
    for x in (np.array([[1, -2], [3, 4]]), np.array([[1 << 20, -(1 << 30)]]), np.zeros((0, 3), np.int64), np.zeros((2, 0), np.int64)):
        assert (vectors.unpacked(vectors.packed(x), *x.shape) == x).all()


def plain_clusters(rows, clusters=16, rounds=3, dims=64):
    good = [(i, integers(v, 64)) for i, v in rows if usable(v, dims)]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in good if i is not None)
    centroids = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for r in range(rounds + 1):
        to = [nearest(v) for _, v in good]
        if r == rounds:
            break
        for n in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(good, to) if c == n]
            if own:
                centroids[n] = [sum(col) // len(own) for col in zip(*own)]
    each = {n: sum(d for d, c in to if c == n) for n in range(len(centroids))}
    return sorted(((i, c, d, each[c], sum(each.values()), ",".join(map(str, centroids[c]))) for (i, _), (d, c) in zip(good, to)), key=repr)


def test_clusters_against_loops(spark):
    rows = clustered(6, 260, dims=5, groups=9, spread=0.3)
    rows += [(3000 + i, [0.5, 0.25, 0.0, -0.25, 1.0]) for i in range(150)]  # more than a third is one vector
    rows += [(None, [0.1] * 5), (7, rows[7][1]), (4000, [0.1] * 4), (4001, None), (4002, [0.1, None, 0.0, 0.0, 0.0]), (4003, [NAN] * 5), (4004, [INF, 0.0, 0.0, 0.0, 0.0])]
    got = ball_clusters.cluster(frame(spark, rows).repartition(3), dims=5, leaf=4, tree_rows=50)
    assert got.dtypes == [("id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid", "string")]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_clusters(rows, dims=5)


def test_ties_and_few_and_none(spark):
    grid = [(i, [float(x), float(y)]) for i, (x, y) in enumerate((x, y) for x in range(5) for y in range(5))]
    for n in (25, 3, 1):
        got = ball_clusters.cluster(frame(spark, grid[:n]), clusters=4, dims=2, leaf=2)
        assert sorted(map(tuple, got.collect()), key=repr) == plain_clusters(grid[:n], clusters=4, dims=2)
    assert ball_clusters.cluster(frame(spark, grid).limit(0), dims=2).count() == 0
    assert ball_clusters.cluster(frame(spark, grid), dims=3).count() == 0


def test_large_components_cluster_exactly(spark):
    r = random.Random(8)
    rows = [(i, [float(r.randrange(-2_000_000, 2_000_000)) for _ in range(4)]) for i in range(200)] + [(900, [1e30] * 4)]
    got = ball_clusters.cluster(frame(spark, rows), dims=4, leaf=8)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_clusters(rows[:-1], dims=4)


def test_balls_spare_vectors():
    x = np.floor(64 * np.array([v for _, v in clustered(9, 4000, groups=12, spread=0.02)])).astype(np.int64)
    tree = ball_clusters.grown(list(range(len(x))), x)
    for i in range(len(tree.low)):
        own = tree.vectors[tree.low[i] : tree.high[i]]
        assert (own.sum(axis=0) == tree.sums[i]).all() and np.linalg.norm(own - tree.middle[i].astype(float), axis=1).max() <= tree.radius[i] + 1e-6
    centroids, did = x[:12], ball_clusters.Filtered()
    counts, sums, _, _ = ball_clusters.assigned(tree, centroids, did)
    own = ((x[:, None] - centroids[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (counts == np.bincount(own, minlength=12)).all() and all((sums[c] == x[own == c].sum(axis=0)).all() for c in range(12))
    assert did.measured + did.spared == len(x) and did.spared > len(x) / 3


def test_queries_against_loops(spark, tmp_path):
    rows = clustered(10, 240, dims=64) + ODD + [(5000 + i, [0.125] * 64) for i in range(40)]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    asked = [(i, v) for i, v in rows if i is not None and i % 50 == 0]
    assert sorted(map(tuple, queries.op12_metric_search(spark, str(tmp_path)).collect())) == plain_top(rows, asked, 5)
    got = queries.op13_ball_clusters(spark, str(tmp_path)).collect()
    wanted = [(*x[:5], hashlib.sha256(x[5].encode()).hexdigest()) for x in plain_clusters(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_quantised_floors_doubles(spark):
    rows = [(1, [0.1, -0.1, 0.0, -1e-30, 0.00390625, 1.5])]
    (got,) = vectors.quantised(frame(spark, rows), 256, "vec_id", "embedding").collect()
    assert got.v == integers(rows[0][1], 256) == [25, -26, 0, -1, 1, 384]
    assert vectors.quantised(frame(spark, rows), 256, "vec_id", "embedding").select(vectors.self_product(F.col("v"))).first()[0] == sum(x * x for x in got.v)
