"""k-means over metric trees: whole balls go to one centroid where the triangle inequality says so.

Each task builds trees of its own rows. A node is a ball: a middle, a radius, how many vectors it
holds and their sum as integers. Where the second nearest centroid is farther from all of a ball
than the nearest can be, the ball's count and sum are added at once; else its halves are looked at,
and in a leaf each vector is measured exactly. Sums are integers, so that results don't depend on
how rows were dealt out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.vectors import EXACT, chunks, packed, quantised, unpacked
from harvestry.llm.workers import map_batches
from harvestry.scratch import materialise

#: Vectors of a leaf, and of a tree, at most.
LEAF, TREE_ROWS, TREE_BYTES = 48, 16_384, 4 << 20
TREES = "ids array<long>, vectors binary, low binary, high binary, below binary, middle binary, radius binary, sums binary"
#: Relative to the distances compared, far more than what doubles get wrong.
_SLACK = 1e-7


@dataclass
class Balls:
    """A tree: vectors in an order in which node i holds [low[i], high[i]); below[i] is the first of its two halves, 0 in a leaf."""

    ids: list[int | None]
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    below: np.ndarray
    middle: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def grown(ids: list[int | None], x: np.ndarray, leaf: int = LEAF) -> Balls:
    """The tree over the rows of x: each node halved between two far members, down to leaves."""
    order, wide = np.arange(len(x)), x.astype(np.float64)
    low, high, below, todo = [0], [len(x)], [0], [0]
    while todo:
        node = todo.pop()
        a, b = low[node], high[node]
        own = wide[order[a:b]]
        if b - a <= leaf or (own == own[0]).all():
            continue
        u = own[_squares(own - own[0]).argmax()]
        v = own[_squares(own - u).argmax()]
        order[a:b] = order[a:b][np.argsort(own @ (v - u), kind="stable")]
        half = (a + b) // 2
        below[node] = len(low)
        todo += [len(low), len(low) + 1]
        low += [a, half]
        high += [half, b]
        below += [0, 0]
    x, wide = x[order], wide[order]
    total = np.concatenate([np.zeros((1, x.shape[1]), np.int64), np.cumsum(x, axis=0)])
    low, high = np.array(low), np.array(high)
    sums = total[high] - total[low]
    # float32 middles, and radii around just those
    middle = (sums / (high - low)[:, None]).astype(np.float32)
    radius = np.sqrt([_squares(wide[a:b] - m).max() for a, b, m in zip(low, high, middle.astype(np.float64), strict=True)])
    return Balls([ids[i] for i in order], x, low, high, np.array(below), middle, radius, sums)


def _squares(d: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", d, d)


def exact_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centroids, int64; both are integers."""
    a, b = (_squares(y.astype(np.float64)).max(initial=0.0) for y in (x, centroids))
    if max(a, b) < EXACT:
        w, c = x.astype(np.float64), centroids.astype(np.float64)
        return (_squares(w)[:, None] + _squares(c)[None] - 2.0 * (w @ c.T)).astype(np.int64)
    return np.stack([_squares(x - c) for c in centroids], axis=1)


@dataclass
class Filtered:
    """What a pass did: balls taken whole, the vectors in them, and vectors that were measured."""

    balls: int = 0
    spared: int = 0
    measured: int = 0


def assigned(tree: Balls, centroids: np.ndarray, did: Filtered | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts and sums a centroid, and the nodes taken whole with their centroids (-1: measured one by one in spans).

    Level by level: balls that no centroid can have for itself alone give way to their halves.
    """
    k, dims = centroids.shape
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    wide = centroids.astype(np.float64)
    nodes, taken, owners = np.zeros(1, np.int64), [], []
    while len(nodes):
        d = np.sqrt(np.maximum(_squares(tree.middle[nodes].astype(np.float64))[:, None] + _squares(wide)[None] - 2.0 * (tree.middle[nodes].astype(np.float64) @ wide.T), 0.0))
        first = d.argmin(axis=1)
        nearest = d[np.arange(len(nodes)), first]
        if k > 1:
            d[np.arange(len(nodes)), first] = np.inf
            second = d.min(axis=1)
            scale = np.sqrt(_squares(wide).max()) + nearest + tree.radius[nodes]
            whole = second - tree.radius[nodes] > nearest + tree.radius[nodes] + _SLACK * scale
        else:
            whole = np.ones(len(nodes), bool)
        at, own = nodes[whole], first[whole]
        np.add.at(counts, own, tree.high[at] - tree.low[at])
        np.add.at(sums, own, tree.sums[at])
        taken.append(at)
        owners.append(own)
        rest = nodes[~whole]
        leaves = rest[tree.below[rest] == 0]
        taken.append(leaves)
        owners.append(np.full(len(leaves), -1))
        rest = tree.below[rest[tree.below[rest] > 0]]
        nodes = np.concatenate([rest, rest + 1])
        if did:
            did.balls, did.spared = did.balls + len(at), did.spared + int((tree.high[at] - tree.low[at]).sum())
    taken, owners = np.concatenate(taken), np.concatenate(owners)
    rows = _members(tree, taken[owners < 0])
    if len(rows):
        own = exact_distances(tree.vectors[rows], centroids).argmin(axis=1)
        counts += np.bincount(own, minlength=k)
        order = np.argsort(own, kind="stable")
        starts = np.searchsorted(own[order], np.arange(k))
        for c in np.unique(own):
            sums[c] += tree.vectors[rows[order[starts[c] : starts[c] + np.count_nonzero(own == c)]]].sum(axis=0)
    if did:
        did.measured += len(rows)
    return counts, sums, taken, owners


def _members(tree: Balls, nodes: np.ndarray) -> np.ndarray:
    sizes = tree.high[nodes] - tree.low[nodes]
    return np.repeat(tree.low[nodes] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if len(nodes) else np.zeros(0, np.int64)


def clusters_of(tree: Balls, centroids: np.ndarray, did: Filtered | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The centroid of each vector, the smaller number at a tie, and the exact squared distance to it."""
    _, _, taken, owners = assigned(tree, centroids, did)
    cluster, distance = np.zeros(len(tree.ids), np.int64), np.zeros(len(tree.ids), np.int64)
    rows = _members(tree, taken[owners < 0])
    if len(rows):
        d = exact_distances(tree.vectors[rows], centroids)
        cluster[rows] = d.argmin(axis=1)
        distance[rows] = d[np.arange(len(rows)), cluster[rows]]
    for c in np.unique(owners[owners >= 0]):
        rows = _members(tree, taken[owners == c])
        cluster[rows] = c
        distance[rows] = exact_distances(tree.vectors[rows], centroids[c : c + 1])[:, 0]
    return cluster, distance


_ARRAYS = {"low": "<i4", "high": "<i4", "below": "<i4", "middle": "<f4", "radius": "<f8", "sums": "<i8"}


def trees(vectors: DataFrame, leaf: int = LEAF, tree_rows: int = TREE_ROWS, tree_bytes: int = TREE_BYTES) -> DataFrame:
    """TREES over vectors (id, v) where the rows lie: no shuffle, and a task holds one tree's rows at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in chunks(batches, tree_rows, tree_bytes):
            t = grown(ids, x, leaf)
            stored = [np.ascontiguousarray(getattr(t, name), kind).tobytes() for name, kind in _ARRAYS.items()]
            yield pa.RecordBatch.from_arrays([pa.array([t.ids], pa.list_(pa.int64())), *(pa.array([b], pa.binary()) for b in (packed(t.vectors), *stored))], ["ids", "vectors", *_ARRAYS])

    return map_batches(vectors, run, TREES)


def _read(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[Balls]:
    for batch in batches:
        for row in batch.to_pylist():
            parts = {name: np.frombuffer(row[name], kind) for name, kind in _ARRAYS.items()}
            parts |= {name: parts[name].reshape(-1, dims) for name in ("middle", "sums")}
            yield Balls(row["ids"], unpacked(row["vectors"], len(row["ids"]), dims), **parts)


def _sums(forest: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, place, total, n): sums of components, n the same in all rows of a cluster; a task gives its own once."""
    k, dims = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for tree in _read(batches, dims):
            n, s, _, _ = assigned(tree, centroids)
            counts += n
            sums += s
        own = np.flatnonzero(counts)
        columns = (np.repeat(own, dims), np.tile(np.arange(dims), len(own)), sums[own].reshape(-1), np.repeat(counts[own], dims))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "place", "total", "n"])

    return map_batches(forest, run, "cluster long, place long, total long, n long").groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def _clusters(forest: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of all vectors of all trees."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree in _read(batches, centroids.shape[1]):
            cluster, distance = clusters_of(tree, centroids)
            yield pa.RecordBatch.from_arrays([pa.array(tree.ids, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    return map_batches(forest, run, "id long, cluster int, distance long")


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hex SHA-256 of `seed:id`, in that order; equal hashes go by the vectors, null ids never start."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    found = vectors.filter("id is not null").select(place.alias("place"), "v").orderBy("place", "v").limit(clusters).collect()  # `clusters` rows
    return np.array([r["v"] for r in found], np.int64)


def cluster(
    rows: DataFrame, clusters: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64, seed: int = 1, key: str = "vec_id", vector: str = "embedding", **tree: int
) -> DataFrame:
    """(id, cluster int, distance, cluster_inertia, inertia, centroid string): a row for each vector of dims components.

    Components are turned to floor(scale * x). first_centroids() start; each round assigns all vectors
    to the nearest centroid (squared Euclidean distance, the smaller number at a tie) and moves each
    centroid that has any to floor(sum / count) of its vectors' components; after the last round they
    are assigned once more. distance is squared, the inertias are its sums, and centroid is the final
    centroid's components joined by commas. With fewer vectors than clusters, each starts one.

    Vectors that are null, of another length, hold null or non-finite components or are too long for
    distances of 64 bits (quantised()) are left out; a null id is kept but starts no centroid; repeated
    rows count each; no vectors give no rows. Other columns aren't read.

    The trees are written once; a round reads them and brings clusters x (dims + 1) numbers a task to
    the sums, and as many to the driver, whatever the rows. Nothing else is shuffled, so a vector that
    a third of all rows share is a ball of radius 0 in many trees, and no hot key.
    """
    good = quantised(rows, scale, key, vector, dims)
    centroids = first_centroids(good, clusters, seed)
    if not len(centroids):
        return good.select("id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid")).limit(0)
    forest = materialise(trees(good, **tree), "balls")
    for _ in range(rounds):
        new = centroids.copy()
        for c, place, total, n in _sums(forest, centroids).collect():  # a row a component of a centroid
            new[c, place] = total // n
        centroids = new
    found = materialise(_clusters(forest, centroids), "clusters")
    spec = found.groupBy("cluster").agg(F.sum("distance").alias("s"))
    inertia = {r["cluster"]: r["s"] for r in spec.collect()}  # a row a cluster
    facts = [(c, inertia.get(c, 0), sum(inertia.values()), ",".join(map(str, v))) for c, v in enumerate(centroids.tolist())]
    small = found.sparkSession.createDataFrame(facts, "c int, cluster_inertia long, inertia long, centroid string")
    return found.join(F.broadcast(small), F.col("cluster") == F.col("c")).select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
