"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Sets whose similarity reaches the threshold share one of their first tokens in any order that all
sets agree on. Documents that share such a token meet in the bucket of the least document that has the token.
Inside a bucket, inverted lists of whole sets are searched: short ones are merged by a heap, long ones
are probed by binary search for what the merge leaves, and overlaps decide exactly. Exact copies are
one set from the start.
"""

from __future__ import annotations

import itertools
import uuid
from bisect import bisect_left
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.llm.components import components
from harvestry.llm.samples import bounded
from harvestry.llm.shingles import RARE, Shingler, may_be_similar, parity_sketch, prefix_length
from harvestry.llm.workers import kept, map_batches
from harvestry.scratch import materialise

#: The order of tokens is steered by so many documents, frequent words and frequent shingles; results don't depend on it.
SAMPLE_DOCS, FREQUENT_WORDS, FREQUENT_SHINGLES, FREQUENT_IN = 12_000, 20_000, 200_000, 6
#: A bucket of more documents or tokens is searched in blocks of about so many.
BLOCK_DOCS, BLOCK_TOKENS = 4096, 4_000_000
#: Bits of the filter that lets through the documents of buckets.
FILTER_BITS = 1 << 23


def merge_skip(lists: list[list[int]], least: int) -> tuple[list[int], list[int]]:
    """What at least `least` of the ascending lists hold, ascending, and how many hold it.

    A heap of the lists' heads gives equal ones together. Where too few are equal, so many lists
    leave the heap that the rest alone couldn't reach `least`, and each jumps by binary search to
    the head that is left.
    """
    heap = [(x[0], k) for k, x in enumerate(lists) if x]
    heapify(heap)
    at, found, counts = [0] * len(lists), [], []
    while len(heap) >= least:
        head, out = heap[0][0], []
        while heap and heap[0][0] == head:
            out.append(heappop(heap)[1])
        if len(out) >= least:
            found.append(head)
            counts.append(len(out))
            goal = head + 1
        else:
            while len(out) < least - 1 and heap:
                out.append(heappop(heap)[1])
            if not heap:
                break
            goal = heap[0][0]
        for k in out:
            at[k] = bisect_left(lists[k], goal, at[k])
            if at[k] < len(lists[k]):
                heappush(heap, (lists[k][at[k]], k))
    return found, counts


def divide_skip(sets: list[np.ndarray], parts: list[int] | None = None, percent: int = 80) -> list[tuple[int, int]]:
    """Edges between positions in sets that join what is similar: a forest of the links.

    With parts, only sets of part 0 are looked for among those of part 1. A pair that the edges so
    far connect isn't decided again. Sets are sorted arrays of distinct tokens, none empty.
    """
    sizes = np.array([len(s) for s in sets])
    inside = np.arange(len(sets)) if parts is None else np.flatnonzero(np.array(parts) == 1)
    asked = np.arange(len(sets)) if parts is None else np.flatnonzero(np.array(parts) == 0)
    if not len(inside) or not len(asked):
        return []
    flat = np.concatenate([sets[i] for i in inside])
    owner = np.repeat(inside, sizes[inside])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    keys, ends = flat[first], np.append(first[1:], len(flat))
    root, edges, own = np.arange(len(sets)), [], parts is None
    for q in asked[np.argsort(-sizes[asked], kind="stable")]:
        n = int(sizes[q])
        t = -(-percent * n // 100)
        at = np.searchsorted(keys, sets[q])
        at[at == len(keys)] = 0
        at = at[keys[at] == sets[q]]
        length = ends[at] - first[at]
        if own:
            at, length = at[length > 1], length[length > 1]
        if len(at) < t or (root[inside] == root[q]).all():
            continue
        rank = np.argsort(length, kind="stable")
        at, length = at[rank], length[rank]
        # so many long lists are probed that the few short ones are merged in little time
        aside = min(t - 1, int(t / (0.01 * np.log2(float(length[-1]) + 1) + 1)))
        short, long = at[: len(at) - aside], at[len(at) - aside :]
        # who is connected with q already leaves the lists before they are merged
        inside_short = np.concatenate([owner[first[k] : ends[k]] for k in short])
        open_ = root[inside_short] != root[q]
        if not open_.any():
            continue
        borders = np.searchsorted(np.repeat(np.arange(len(short)), ends[short] - first[short])[open_], np.arange(len(short) + 1))
        rest = inside_short[open_].tolist()
        found, count = (np.array(x, np.int64) for x in merge_skip([rest[a:b] for a, b in itertools.pairwise(borders.tolist())], t - aside))
        fits = (root[found] != root[q]) & (100 * np.minimum(sizes[found], n) >= percent * np.maximum(sizes[found], n))
        found, count = found[fits], count[fits]
        for i, k in enumerate(long):
            alive = count + (aside - i) >= t
            found, count = found[alive], count[alive]
            if not len(found):
                break
            members = owner[first[k] : ends[k]]
            place = np.searchsorted(members, found)
            place[place == len(members)] = 0
            count = count + (members[place] == found)
        for c in found[100 * count >= percent * (n + sizes[found] - count)]:
            if root[c] != root[q]:
                root[root == root[c]] = root[q]
                edges.append((int(q), int(c)))
    return edges


def _stars(ids: list[int], edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(least id, id) for each id that the edges between positions connect with a lesser one."""
    up = {}

    def top(x):
        while up.get(x, x) != x:
            up[x] = x = up.get(up[x], up[x])
        return x

    for a, b in edges:
        a, b = sorted((top(ids[a]), top(ids[b])))
        up.setdefault(a, a)
        up[b] = a
    return [(top(x), x) for x in list(up) if top(x) != x]


def _order(docs: DataFrame) -> tuple[dict[bytes, int], np.ndarray]:
    """Frequent words with their rarity, and frequent shingles' tokens, both from a bounded sample."""
    chosen = F.broadcast(bounded(docs.select(F.col("id").alias("sid")), SAMPLE_DOCS).distinct())  # at most SAMPLE_DOCS rows
    sample = materialise(docs.join(chosen, F.col("id") == F.col("sid"), "left_semi").select("body"), "sample")

    def words(batches):
        for batch in batches:
            for text in batch.column(0):
                found = (text.as_py() or b"").lower().split()
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["w"])

    counted = map_batches(sample, words, "w binary").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.orderBy(F.desc("n"), "w").limit(FREQUENT_WORDS).collect()
    total = max(1, sum(r["n"] for r in rows))
    frequent = {bytes(r["w"]): min(RARE, (total // r["n"]).bit_length()) for r in rows if r["n"] > 1}

    def shingled(batches):
        make = Shingler(frequent)
        for batch in batches:
            found = make.batch(batch.column(0))
            if any(map(len, found)):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["t"])

    often = map_batches(sample, shingled, "t long").groupBy("t").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= FREQUENT_IN)
    hot = np.sort(np.array([r["t"] for r in often.orderBy(F.desc("n"), "t").limit(FREQUENT_SHINGLES).collect()], np.int64))
    return frequent, hot


def _grouped(batches, keys: int):
    """(key values, rows of the other values) of consecutive rows with equal first columns."""
    now, rows = None, []
    for batch in batches:
        for values in zip(*batch.columns, strict=True):  # row by row: texts may be long
            row = tuple(x.as_py() for x in values)
            if row[:keys] != now:
                if rows:
                    yield now, rows
                now, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield now, rows


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values are in an ascending array."""
    if not len(of):
        return np.zeros(len(values), bool)
    place = np.searchsorted(of, values)
    place[place == len(of)] = 0
    return of[place] == values


def similar_documents(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles (long) and component_id of every row, over whole texts.

    Documents link when 100 * intersection >= percent * union of their sets; component_id is the
    least id that links reach. Without words (null or empty text) a document has no set and its
    own id. Rows that share an id are one document to the links, each with its own n_shingles; a
    null id links with nothing and stays null. An empty table gives an empty result; other columns
    aren't read.

    What is dealt out by token is 1 - percent / 100 of the tokens, rarest words first, and only
    their least documents' buckets see texts again, after sizes and parity sketches have ruled out most. Shingles that a sample shows to be frequent
    come last in the order, so only documents made of little else meet on them; those are summed in
    each task and never dealt out by token. Buckets over BLOCK_DOCS or BLOCK_TOKENS fall into classes of
    set sizes and these into blocks; pairs of blocks of the same class or of neighbouring ones are
    searched, each a task of bounded size.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("body"))
    frequent, hot = _order(base)
    run = uuid.uuid4().hex
    shingler = lambda: kept(("shingles", run), lambda: Shingler(frequent))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def sets(batches):
        make, most = shingler(), np.iinfo(np.int64).max
        least = np.full(len(hot), most)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            sizes, marks, sketches, colds, hots = [], [], [], [], []
            for i, found in zip(ids, make.batch(batch.column(1)), strict=True):
                sizes.append(len(found))
                marks.append(xxhash.xxh3_128_digest(found.tobytes()))
                sketches.append(parity_sketch(found))
                want = prefix_length(len(found), percent)
                late = _member(found, hot)
                if i is not None:
                    at = np.searchsorted(hot, found[late])
                    least[at] = np.minimum(least[at], i)
                cold = found[~late][:want]
                colds.append(cold)
                hots.append(found[late][: want - len(cold)])
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(np.concatenate(x) if x else np.empty(0, np.int64))) for x in (colds, hots)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()), pa.array(sketches, pa.binary()), *lists], names)
        some = np.flatnonzero(least < most)
        if len(some):  # a row of another kind: the task's least ids of frequent shingles
            both = [pa.array([x], pa.list_(pa.int64())) for x in (some, least[some])]
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([-1], pa.int64()), pa.array([b""], pa.binary()), pa.array([b""], pa.binary()), *both], names)

    names = ["id", "n", "mark", "sketch", "cold", "hot"]
    every = materialise(map_batches(base, sets, "id long, n long, mark binary, sketch binary, cold array<long>, hot array<long>"), "sets")
    made = every.filter("n >= 0")
    real = made.filter("n > 0 and id is not null")
    groups = materialise(real.groupBy("mark", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "groups")
    real = real.join(groups.select("rep").distinct(), F.col("id") == F.col("rep"), "left_semi")
    reps = real.select("id", "n", "cold", "hot")

    dealt = reps.select("id", "n", F.explode("cold").alias("t")).repartition(parts, "t")
    shared = dealt.groupBy("t").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("pivot")).filter("c > 1").select("t", "pivot")
    cold = dealt.join(shared.hint("shuffle_hash"), "t").select("id", "n", "pivot")

    pivots = np.zeros(len(hot), np.int64)
    told = every.filter("n = -1").select(F.explode(F.arrays_zip("cold", "hot")).alias("x")).groupBy("x.cold").agg(F.min("x.hot").alias("pivot"))
    for row in told.collect():  # at most FREQUENT_SHINGLES
        pivots[row["cold"]] = row["pivot"]

    def hot_buckets(batches):
        for batch in batches:
            lists = batch.column(2)
            found = pivots[np.searchsorted(hot, lists.flatten().to_numpy())]
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            order = np.lexsort((found, row))
            row, found = row[order], found[order]
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (found[1:] != found[:-1])]) if len(row) else np.zeros(0, bool)
            row, found = row[new], found[new]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(found)], ["id", "n", "pivot"])

    members = cold.unionByName(map_batches(reps.filter("size(hot) > 0").select("id", "n", "hot"), hot_buckets, "id long, n long, pivot long")) if len(hot) else cold
    members = materialise(members.distinct(), "members")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int")
    # written first, so that the joins read plain exchanges, which adaptive execution can split at a hot pivot
    plan = materialise(members.groupBy(F.col("pivot").alias("p")).agg(blocks.alias("pieces"), F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m"), "plan")
    # a large bucket falls into classes of sizes, of which only neighbours can hold similar sets, and these into blocks
    step = float(np.log(100 / percent * 1.01))
    placed = members.join(plan, F.col("pivot") == F.col("p")).withColumn("class", F.when(F.col("pieces") > 1, F.floor(F.log("n") / step).cast("int")).otherwise(0)).drop("p")
    classes = placed.filter("pieces > 1").groupBy(F.col("pivot").alias("p"), F.col("class").alias("c")).agg(blocks.alias("blocks"))
    up = Window.partitionBy("p").orderBy("c")
    ends = F.sum("blocks").over(up.rowsBetween(Window.unboundedPreceding, 0))
    near = lambda other, to: F.when(other("c").over(up) == F.col("c") + to, other("blocks").over(up)).otherwise(0)
    classes = classes.select("p", "c", "blocks", (ends - F.col("blocks")).alias("first"), near(F.lag, -1).alias("below"), near(F.lead, 1).alias("above"))
    classes = materialise(classes.select("p", "c", "blocks", "first", (F.col("first") - F.col("below")).alias("from"), (F.col("first") + F.col("blocks") + F.col("above")).alias("to")), "classes")
    placed = placed.join(classes, (F.col("pivot") == F.col("p")) & (F.col("class") == F.col("c")), "left")
    number = lambda name, alone: F.coalesce(F.col(name), F.lit(alone)).cast("int")
    placed = placed.select("pivot", "id", "n", number("from", 0).alias("from"), number("to", 1).alias("to"), (number("first", 0) + F.pmod(F.xxhash64("id"), number("blocks", 1))).cast("int").alias("block"))
    tasks = F.transform(F.sequence(F.col("from"), F.col("to") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    sketched = placed.join(real.select(F.col("id").alias("sid"), "sketch"), F.col("id") == F.col("sid"))
    spread = sketched.select("pivot", "block", F.explode(tasks).alias("task"), "id", "n", "sketch").select("pivot", "task.i", "task.j", "block", "id", "n", "sketch")

    def likely(batches):
        for task, rows in _grouped(batches, 3):
            block, ids, sizes = (np.array([x[k] for x in rows]) for k in range(3))
            keep = np.zeros(len(rows), bool)
            if len(rows) > 1:
                keep = may_be_similar(sizes, [x[3] for x in rows], percent, None if task[1] == task[2] else block != task[1])
            if keep.any():
                n = int(keep.sum())
                yield pa.RecordBatch.from_arrays([*(pa.array([x] * n, k) for x, k in zip(task, (pa.int64(), pa.int32(), pa.int32()), strict=True)), pa.array(block[keep], pa.int32()), pa.array(ids[keep])], ["pivot", "i", "j", "block", "id"])

    dealt_tasks = lambda df: df.repartition(parts, "pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")
    placed = materialise(map_batches(dealt_tasks(spread), likely, "pivot long, i int, j int, block int, id long"), "likely")

    # a filter of fixed size first, so that only texts that some bucket may want are moved
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    words = placed.select(place(F.col("id")).alias("b")).distinct().groupBy(F.shiftright("b", 6).alias("fw")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits"))
    wanted = (
        base.withColumn("b", place(F.col("id")))
        .join(F.broadcast(words), F.shiftright("b", 6) == F.col("fw"))  # FILTER_BITS / 64 rows at most
        .filter(F.expr("(bits & shiftleft(1L, cast(b % 64 as int))) != 0"))
        .select(F.col("id").alias("wid"), "body")
    )
    told = placed.join(wanted, F.col("id") == F.col("wid")).select("pivot", "i", "j", "block", "id", "body")

    def search(batches):
        make = shingler()
        for task, rows in _grouped(batches, 3):
            found = make.batch(pa.array([body for _, _, body in rows], pa.binary()))
            sets = [(i, block, tokens) for (block, i, _), tokens in zip(rows, found, strict=True) if len(tokens)]
            if len(sets) < 2:
                continue
            ids, blocks, found = zip(*sets, strict=True)
            edges = divide_skip(list(found), None if task[1] == task[2] else [int(b != task[1]) for b in blocks], percent)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*_stars(list(ids), edges), strict=True)], ["a", "b"])

    found = map_batches(dealt_tasks(told), search, "a long, b long")
    roots = components(found)
    named = groups.join(roots, F.col("rep") == F.col("node"), "left").select(F.col("mark").alias("gm"), F.col("n").alias("gn"), F.least("rep", F.coalesce("root", "rep")).alias("component"))
    return made.join(named, (F.col("mark") == F.col("gm")) & (F.col("n") == F.col("gn")), "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("component", "id")).otherwise(F.col("id")).alias("component_id")
    )
