"""Best-fit packing of token pieces into sequences, by hierarchical rounds over residual bins."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.tokens import encoder
from harvestry.llm.workers import map_batches
from harvestry.scratch import materialise

CAPACITY = 4096
#: A bin this full goes out at once.
NEARLY_FULL = 0.995
#: What a task packs at a time: so many items, or items of so many pieces.
MOST_ITEMS, MOST_PIECES = 20_000, 1_000_000
#: Rounds go on while they leave fewer open bins than this share of the items they got.
WORTH = 0.98
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
_NAMES = PIECES.replace(",", "").split()[::2]
_MEMBERS = "array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>>"
_BINS = f"size long, done boolean, sequence_id long, members {_MEMBERS}"


def _cut(batches: Iterable[pa.RecordBatch], tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches of (id, body) to batches of pieces."""
    enc = encoder(tokenizer)
    for batch in batches:
        row, columns, parts = [], [[] for _ in range(4)], []
        for i, body in enumerate(batch.column(1)):
            ids = enc.wide(body.as_py(), end_id)
            for piece, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at : at + capacity]
                row.append(i)
                for column, value in zip(columns, (piece, at, len(part), zlib.crc32(part)), strict=True):
                    column.append(value)
                if with_ids:
                    parts.append(part.tobytes())
        out = [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, _KINDS[1:], strict=True))]
        yield pa.RecordBatch.from_arrays([*out, pa.array(parts, pa.binary())], [*_NAMES, "ids"]) if with_ids else pa.RecordBatch.from_arrays(out, _NAMES)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("body"))


def tokenised_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of every whole text (null: empty) with end_id appended: PIECES, and ids if asked for.

    Only documents of more than capacity ids are cut, into pieces of capacity ids; the last may be
    shorter. Every row gives a piece at least, its end id. Other columns aren't read.
    """
    return map_batches(_texts(docs, key, text), lambda b: _cut(b, tokenizer, capacity, end_id, with_ids), PIECES + ", ids binary" * with_ids)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of positions in lengths.

    Bins stand by free room, and a bit says which rooms there are, so that the tightest one that
    takes an item is found with a shift. Ties go by position.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[i]
        if fit := rooms >> size:
            room = size + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            b, room = len(bins), capacity
            bins.append([i])
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


def _packed(items: pa.Table, capacity: int) -> tuple[np.ndarray, pa.ListArray]:
    """Sizes and members of the bins that best fit makes of items (size, members)."""
    sizes = items.column("size").to_pylist()
    members = items.column("members").combine_chunks()
    if isinstance(members, pa.ChunkedArray):
        members = pa.concat_arrays(members.chunks)
    flat, ends = members.flatten(), members.offsets.to_numpy()
    ends = ends - ends[0]
    bins = best_fit(sizes, capacity)
    order = np.array([i for b in bins for i in b], np.int64)
    counts = (ends[1:] - ends[:-1])[order]
    # the members of the items in the order of the bins, each shifted by the items before it
    take = np.repeat(ends[:-1][order] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    shift = np.concatenate([np.cumsum([0, *(sizes[i] for i in b[:-1])]) for b in bins])
    flat = flat.take(pa.array(take))
    columns = [flat.field(k) for k in range(5)]
    columns.append(pa.array(flat.field(5).to_numpy(zero_copy_only=False) + np.repeat(shift, counts)))
    inner = pa.StructArray.from_arrays(columns, fields=[flat.type.field(k) for k in range(6)])
    per_bin = np.add.reduceat(counts, np.cumsum([0, *map(len, bins[:-1])]))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_bin)]), pa.int32()), inner)
    return np.array([sum(sizes[i] for i in b) for b in bins], np.int64), lists


def _round(level: int, capacity: int, full: float, most_items: int, most_pieces: int) -> Callable:
    """A function over batches of items (size, members) that yields bins.

    It packs as many items at a time as the bounds say. Bins that aren't full meet the next ones,
    or go out as open if they are half of the bound already.
    """

    def run(batches):
        from pyspark import TaskContext

        first, made = (level << 56) + (TaskContext.get().partitionId() << 32), 0

        def out(size, lists, done):
            nonlocal made
            for at in range(0, len(size), 2000):
                n = len(size[at : at + 2000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(size[at : at + n]), pa.array([done] * n), pa.array(first + made + np.arange(n)), lists.slice(at, n)], ["size", "done", "sequence_id", "members"]
                )
                made += n

        held: list[pa.Table] = []

        def settle(end: bool):
            size, lists = _packed(pa.concat_tables(held), capacity)
            held.clear()
            keep = size < full
            closed = pa.array(~keep)
            yield from out(size[~keep], lists.filter(closed), True)
            size, lists = size[keep], lists.filter(pa.array(keep))
            if end or 2 * len(size) > most_items or 2 * len(lists.flatten()) > most_pieces:
                yield from out(size, lists, False)
            elif len(size):
                held.append(pa.table({"size": size, "members": lists}))

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, most_items)
                at += part.num_rows
                held.append(pa.Table.from_batches([part]))
                if sum(t.num_rows for t in held) >= most_items or sum(len(c.flatten()) for t in held for c in t.column("members").chunks) >= most_pieces:
                    yield from settle(False)
        if held:
            yield from settle(True)

    return run


def _items(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of pieces to batches of items of one piece."""
    for batch in batches:
        n = batch.num_rows
        columns = [batch.column(k) for k in range(5)] + [pa.array(np.zeros(n, np.int64))]
        inner = pa.StructArray.from_arrays(columns, names=[*_NAMES, "offset"])
        yield pa.RecordBatch.from_arrays([batch.column(3), pa.ListArray.from_arrays(pa.array(np.arange(n + 1), pa.int32()), inner)], ["size", "members"])


def _rounds(first: Callable[[Callable], DataFrame], capacity: int, nearly_full: float, most_items: int, most_pieces: int) -> DataFrame:
    """first(round) gives the bins of round 0; the rounds after it, and all members of all bins."""
    room = lambda level: _round(level, capacity, nearly_full * capacity, most_items, most_pieces)
    packed, level, given, closed = materialise(first(room(0)), "round0"), 0, None, []
    while True:
        left = packed.filter("not done").agg(F.count(F.lit(1)), F.min("size"), F.sum(F.size("members"))).first()
        if not left[0] or (given is not None and (given[1] == 1 or left[0] > WORTH * given[0])):
            closed.append(packed)
            break
        # what not even the smallest open bin fits into is done as well
        done = F.col("done") | (F.col("size") > capacity - left[1])
        closed.append(packed.filter(done))
        rest = packed.filter(~done).select("size", "members")
        n = rest.count()
        if n < 2:
            closed.append(packed.filter(~done))
            break
        tasks = max(-(-n // most_items), -(-left[2] // most_pieces))
        level += 1
        given = (n, tasks)
        packed = materialise(map_batches(rest.repartition(tasks), room(level), _BINS), f"round{level}")
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out.select("sequence_id", F.explode("members").alias("m")).select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")


def pack(pieces: DataFrame, capacity: int = CAPACITY, nearly_full: float = NEARLY_FULL, most_items: int = MOST_ITEMS, most_pieces: int = MOST_PIECES) -> DataFrame:
    """PIECES, sequence_id long and offset long for each piece of 1 to capacity ids.

    Round 0 packs each partition by best fit where it lies. Full bins, and those that no open one
    fits into, are done; the others become items of their own, meet in as many tasks as their
    number asks for, and so on, until one task has had them all or a round leaves over WORTH of
    what it got. No task ever packs more than most_items items or most_pieces pieces at a time. A
    bin carries its members (at most capacity, as none is empty), so merging it only shifts their
    offsets. Each round is written before it is read twice: a lost executor can't change what was
    already sent out. Null document ids, ties and repeated rows are pieces like others; no pieces
    give no rows; other columns aren't read.
    """
    named = pieces.select(*_NAMES)
    return _rounds(lambda one: map_batches(named, lambda b: one(_items(b)), _BINS), capacity, nearly_full, most_items, most_pieces)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, key: str = "doc_id", text: str = "text", nearly_full: float = NEARLY_FULL, most_items: int = MOST_ITEMS, most_pieces: int = MOST_PIECES
) -> DataFrame:
    """pack() of tokenised_pieces(), with round 0 in the worker that tokenises."""
    whole = lambda one: map_batches(_texts(docs, key, text), lambda b: one(_items(_cut(b, tokenizer, capacity, end_id))), _BINS)
    return _rounds(whole, capacity, nearly_full, most_items, most_pieces)
