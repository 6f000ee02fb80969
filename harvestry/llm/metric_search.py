"""Exact nearest vectors by inner product: M-trees of bounded size, searched best first.

A tree is a table row of pages. An entry of an inner page is a vector of the page below it (its
routing vector), with the radius that covers all below, the greatest squared length there, and its
distance to the routing vector of its own page; an entry of a leaf is a vector with its own distance
to that. With q.x = (|q|^2 + |x|^2 - |q-x|^2) / 2, every lower bound of a distance is an upper bound
of a score, so stored distances rule out entries, whole pages with them, before anything is computed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.vectors import EXACT, chunks, matrix, packed, padded, quantised, self_product, unpacked
from harvestry.llm.workers import map_batches
from harvestry.scratch import materialise

#: Entries of a page at most.
PAGE = 192
#: Vectors of a tree, and bytes of them as four-byte integers, at most.
TREE_ROWS, TREE_BYTES = 16_384, 4 << 20
#: Bytes of a block of queries, which goes to all trees at once.
BLOCK_BYTES = 8 << 20
_PAGES = "array<struct<leaf:boolean,vectors:binary,apart:binary,radius:binary,most:binary,refs:binary>>"
TREES = f"dims int, rows int, pages {_PAGES}"
#: Relative to (|q| + |x|)^2, far more than what doubles get wrong in a bound.
_SLACK = 1e-7


@dataclass
class Page:
    leaf: bool
    vectors: np.ndarray
    #: Distances of the entries to the routing vector of the page.
    apart: np.ndarray
    #: Covering radii; 0 in a leaf.
    radius: np.ndarray
    #: Greatest squared length below; the vector's own in a leaf.
    most: np.ndarray
    #: Numbers of the pages below, or ids.
    refs: np.ndarray
    lengths: np.ndarray = field(init=False)

    def __post_init__(self):
        wide = self.vectors.astype(np.float64)
        self.lengths = np.einsum("ij,ij->i", wide, wide)
        # exact either way: floats where no product can leave their whole numbers
        self.vectors = wide if not len(wide) or self.lengths.max() < EXACT else self.vectors


@dataclass
class Searched:
    """What a search did: pages opened, entries seen there, and those whose vectors were multiplied."""

    pages: int = 0
    entries: int = 0
    products: int = 0


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x.astype(np.float64) - c
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def _groups(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Positions of x in groups of at most `most` that lie together: halved, as far as needed, between two far members."""
    todo, done = [np.arange(len(x))], []
    while todo:
        at = todo.pop()
        if len(at) <= most:
            done.append(at)
            continue
        own = x[at].astype(np.float64)
        a = own[_distances(own, own[0]).argmax()]
        b = own[_distances(own, a).argmax()]
        pages = -(-len(at) // most)
        left = len(at) * ((pages + 1) // 2) // pages
        order = np.argsort(own @ (b - a), kind="stable")  # |x-a|^2 - |x-b|^2, but for a constant and a factor
        todo += [at[order[left:]], at[order[:left]]]
    return done


def _middle(x: np.ndarray) -> int:
    """The member next to the mean."""
    return int(_distances(x, x.mean(axis=0)).argmin())


def grown(ids: np.ndarray, x: np.ndarray, page: int = PAGE) -> list[Page]:
    """The pages of a tree over the rows of x, the root first; all leaves are at the same depth."""
    below: list[tuple[int, np.ndarray]] = []  # of each page of a level: its routing vector, and all members under it
    pages, level = [], []
    for at in _groups(x, page):
        centre = at[_middle(x[at])]
        level.append(len(pages))
        below.append((centre, at))
        own = x[at].astype(np.float64)
        pages.append(Page(True, x[at], _distances(own, x[centre]), np.zeros(len(at)), np.einsum("ij,ij->i", own, own), ids[at]))
    lengths = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    while len(level) > 1:
        routing = np.array([c for c, _ in below])
        upper, under = [], []
        for at in _groups(x[routing], page):
            centre = routing[at[_middle(x[routing[at]])]]
            radius = np.array([_distances(x[below[i][1]], x[below[i][0]]).max() for i in at])
            most = np.array([lengths[below[i][1]].max() for i in at])
            upper.append(len(pages))
            under.append((centre, np.concatenate([below[i][1] for i in at])))
            pages.append(Page(False, x[routing[at]], _distances(x[routing[at]], x[centre]), radius, most, np.array([level[i] for i in at])))
        level, below = upper, under
    last = len(pages) - 1
    for p in pages:
        if not p.leaf:
            p.refs = last - p.refs
    return pages[::-1]


def search(pages: list[Page], q: np.ndarray, length: float, found: list[tuple[int, int]], k: int, did: Searched | None = None) -> None:
    """Put what belongs to the k best of q, a vector of whole numbers, into found, a heap of (score, -id).

    What found holds from other trees counts from the start. Equal scores are searched for too, as
    ties go to the smaller id.
    """
    reach = np.sqrt(length)
    queue: list[tuple[float, int, float]] = [(-np.inf, 0, -1.0)]
    while queue:
        bound, number, apart = heappop(queue)
        least = found[0][0] if len(found) >= k else -np.inf
        if -bound < least:
            return
        page = pages[number]
        if did:
            did.pages, did.entries = did.pages + 1, did.entries + len(page.refs)
        vectors, refs, lengths, most, radius = page.vectors, page.refs, page.lengths, page.most, page.radius
        slack = _SLACK * (reach + np.sqrt(most.max())) ** 2
        if apart >= 0 and least > -np.inf:
            # by the triangle inequality, from stored distances alone
            low = np.maximum(np.abs(apart - page.apart) - radius, 0.0)
            near = (length + most - low * low) * 0.5 + slack >= least
            if not near.all():
                if not near.any():
                    continue
                vectors, refs, lengths, most, radius = vectors[near], refs[near], lengths[near], most[near], radius[near]
        if did:
            did.products += len(refs)
        exact = vectors.dtype != np.float64 or length >= EXACT
        dots = vectors.astype(np.int64) @ q if exact else vectors @ q.astype(np.float64)
        if page.leaf:
            hits = np.flatnonzero(dots >= least)
            for score, ref in zip(dots[hits].tolist(), refs[hits].tolist(), strict=True):
                one = (int(score), -ref)
                if len(found) < k:
                    heappush(found, one)
                elif one > found[0]:
                    heappushpop(found, one)
            continue
        away = np.sqrt(np.maximum(length + lengths - 2.0 * dots, 0.0))
        low = np.maximum(away - radius, 0.0)
        bounds = np.minimum((length + most - low * low) * 0.5, dots + reach * radius) + slack
        for i in np.flatnonzero(bounds >= least):
            heappush(queue, (-bounds[i], int(refs[i]), float(away[i])))


def _stored(pages: list[Page]) -> list[dict]:
    floats = lambda x: np.ascontiguousarray(x, "<f8").tobytes()
    return [
        {
            "leaf": p.leaf,
            "vectors": packed(p.vectors.astype(np.int64)),
            "apart": floats(p.apart),
            "radius": b"" if p.leaf else floats(p.radius),
            "most": b"" if p.leaf else floats(p.most),
            "refs": np.ascontiguousarray(p.refs, "<i8").tobytes(),
        }
        for p in pages
    ]


def _read(stored: list[dict], dims: int) -> list[Page]:
    out = []
    for s in stored:
        refs = np.frombuffer(s["refs"], "<i8")
        vectors = unpacked(s["vectors"], len(refs), dims)
        floats = {name: np.frombuffer(s[name], "<f8") for name in ("apart", "radius", "most")}
        if s["leaf"]:
            wide = vectors.astype(np.float64)
            floats |= {"radius": np.zeros(len(refs)), "most": np.einsum("ij,ij->i", wide, wide)}
        out.append(Page(s["leaf"], vectors, floats["apart"], floats["radius"], floats["most"], refs))
    return out


def trees(vectors: DataFrame, page: int = PAGE, tree_rows: int = TREE_ROWS, tree_bytes: int = TREE_BYTES) -> DataFrame:
    """TREES over vectors (id, v) where the rows lie: no shuffle, and a task holds one tree's rows at a time."""
    kind = pa.list_(pa.struct([("leaf", pa.bool_()), *((n, pa.binary()) for n in ("vectors", "apart", "radius", "most", "refs"))]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in chunks(batches, tree_rows, tree_bytes):
            made = _stored(grown(np.array(ids, np.int64), x, page))
            yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([made], kind)], ["dims", "rows", "pages"])

    return map_batches(vectors, run, TREES)


def search_trees(forest: DataFrame, ids: list[int], queries: np.ndarray, k: int) -> DataFrame:
    """(rep, score, id): of each query, a row of the matrix, the best k of all trees of a task, a tree after the other."""
    lengths = [int(n) for n in np.einsum("ij,ij->i", queries, queries)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in ids]
        for batch in batches:
            for i in range(batch.num_rows):
                dims = batch.column(0)[i].as_py()
                pages = _read(batch.column(2)[i].as_py(), dims)
                block = padded(queries, dims)
                own = lengths if queries.shape[1] <= dims else [int(n) for n in np.einsum("ij,ij->i", block, block)]
                for q, length, found in zip(block, own, best, strict=True):
                    search(pages, q, float(length), found, k)
        for at in range(0, len(ids), 4096):
            part = [(rep, score, -ref) for rep, found in zip(ids[at : at + 4096], best[at : at + 4096], strict=True) for score, ref in found]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*part, strict=True) if part else ([], [], []))], ["rep", "score", "id"])

    return map_batches(forest, run, "rep long, score long, id long")


def _best(rows: DataFrame, group: str | list[str], k: int, *order: Column | str) -> DataFrame:
    """The first k rows of each group; each task keeps no more than k before they move."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("__rank", rank).filter(F.col("__rank") <= k).drop("__rank")


def top_k(rows: DataFrame, queries: DataFrame, k: int, scale: int = 256, key: str = "vec_id", vector: str = "embedding", block_bytes: int = BLOCK_BYTES, **tree: int) -> DataFrame:
    """(query_id, rank int, id, score): of each row of queries, the k best rows of `rows` but the one that is itself.

    Both tables have key and vector; components are turned to floor(scale * x), and score is the
    integer inner product, where the longer of two vectors is cut. Ties go to the smaller id; rank
    counts from 1; with fewer rows there are fewer results. Vectors that are null, hold a null or
    non-finite component, or are too long for scores of 64 bits (quantised()) take no part, nor do
    rows with a null key. A repeated row is a row of its own: it is found beside itself, and asked
    for by itself. Empty tables give no rows. Other columns aren't read.

    Of equal vectors no more than the k + 1 smallest ids can be among results, so each task keeps
    only those before rows move: a vector that a third of all rows share is a few rows of a tree.
    Equal queries are searched for once. Queries go in blocks of block_bytes, a job a block, over all
    trees; a task takes its trees one after the other, so that what one has given cuts the next.
    """
    good = quantised(rows, scale, key, vector).filter("id is not null")
    distinct = materialise(_best(good, "v", k + 1, "id"), "vectors")
    forest = materialise(trees(distinct, **tree), "trees")
    asked = quantised(queries, scale, key, vector).filter("id is not null").select(F.col("id").alias("query_id"), "v")
    asked = materialise(asked, "asked")
    reps = materialise(asked.groupBy("v").agg(F.min("query_id").alias("rep")), "reps")
    size, widest = reps.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks = max(1, -(-size * 8 * max(widest or 1, 1) // block_bytes))
    answers = None
    for b in range(blocks if size else 0):
        block = reps.filter(F.pmod(F.xxhash64("rep"), F.lit(blocks)) == b).toArrow()  # bounded by block_bytes, whatever the tables
        if not block.num_rows:
            continue
        ids, wide = block.column("rep").to_pylist(), matrix(block.column("v").combine_chunks())
        part = _best(search_trees(forest, ids, wide, k + 1), "rep", k + 1, F.desc("score"), "id")
        part = part.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("low"), "id"))).alias("best"))
        part = materialise(part, "answers")
        answers = part if answers is None else answers.unionByName(part)
    if answers is None:
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("query_id").alias("id"), F.col("query_id").alias("score")).limit(0)
    own = F.struct((-self_product(F.col("v"))).alias("low"), F.col("query_id").alias("id")).alias("own")
    met = asked.select("query_id", "v", own).join(reps.withColumnRenamed("v", "w"), F.col("v") == F.col("w")).select("query_id", "rep", "own")
    met = met.join(answers.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r"))
    # one row that looks like the query's own goes out; if it isn't among the first k + 1, none does
    at = F.array_position("best", F.col("own"))
    others = F.when(at == 0, F.col("best")).otherwise(F.concat(F.slice("best", F.lit(1), (at - 1).cast("int")), F.slice("best", (at + 1).cast("int"), F.lit(k + 1))))
    out = met.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("nth", "x"))
    return out.select("query_id", (F.col("nth") + 1).cast("int").alias("rank"), F.col("x.id").alias("id"), (-F.col("x.low")).alias("score"))
