"""Interpolated modified Kneser-Ney model of two or three words: counted in Spark, kept as sorted
arrays in files of the shared folder, memory-mapped by the workers that score.

Words are numbered by the rank of their 64-bit hash. A pair of words is their two numbers in one
64-bit integer, multiplied by an odd constant so that equal ranges of the products hold equal
shares of the pairs, whatever words are frequent. Triples lie in the range of their first two
words, under each pair the third words in order. No step holds more than a range of anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.files import Writer, mapped, unique
from harvestry.llm.hashing import Hasher
from harvestry.llm.workers import bounded_batches, give_back, kept, map_batches
from harvestry.scratch import drop, materialise, new_folder

#: Words looked at together: each by the two before it.
ORDER = 3
_MIX = 0x9E3779B97F4A7C15
_BACK = pow(_MIX, -1, 1 << 64)
#: Text whose pairs one range holds, and how many times fewer ranges there are of words.
RANGE_BYTES, WORD_RANGES = 16 << 20, 8
#: Pairs followed by more words than this have their sums written down; of 2 ** NEAR starts of stretches one is known whole.
HEAVY, NEAR = 32, 4
#: Bytes of text handled at once by a worker, distinct words and tokens that it gathers before sending them on.
SLICE_BYTES, MAX_WORDS, MAX_TOKENS = 2 << 20, 1_000_000, 3_000_000
#: Word numbers at hand, a power of two.
CACHED = 1 << 19


def slices(batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of (.., body binary) batches of about SLICE_BYTES, with the hashes of their tokens and each body's number of them."""
    hasher = kept("token hashes", Hasher, beside=True)
    for batch in batches:
        body = batch.column(batch.num_columns - 1)
        if not len(body):
            continue
        ends = np.frombuffer(body.buffers()[1], np.int32, len(body) + 1, 4 * body.offset).astype(np.int64)
        at = 0
        while at < len(body):
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1)
            part = batch.slice(at, min(end, len(body)) - at)
            yield part, *hasher.tokens(part.column(part.num_columns - 1))
            at += part.num_rows


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order with their counts' sums."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def by_range(keys: np.ndarray, columns: list[np.ndarray], bits: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Slices of ascending keys by their top bits."""
    edges = np.searchsorted(keys, (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.empty(0, np.uint64))
    edges = np.concatenate([[0], edges, [len(keys)]])
    for r in np.flatnonzero(np.diff(edges)):
        yield int(r), [c[edges[r] : edges[r + 1]] for c in (keys, *columns)]


def planes(values: np.ndarray) -> bytes:
    """64-bit numbers in the least number of bytes that holds them all: a byte for it, then their bytes by place."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    found = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((found.shape[1], 8), np.uint8)
    out[:, : data[0]] = found.T
    return out.view("<u8").ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as planes of their steps."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unplaned(data), dtype=np.uint64)


def _narrow(counts: np.ndarray) -> np.ndarray:
    """counts in the least width that holds them."""
    top = int(counts.max()) if len(counts) else 0
    return counts.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def _write(folder: str, name: str, arrays: list[np.ndarray]) -> tuple[str, str]:
    """A file of arrays; its address, and where and what each array is."""
    uri = unique(folder, name)
    out, about = Writer(uri), []
    for a in arrays:
        out.write(b"\0" * (-out.size % 8))
        about.append(f"{out.write(np.ascontiguousarray(a).tobytes())}:{len(a)}:{a.dtype.str}")
    out.close()
    return uri, ",".join(about)


def _arrays(uri: str, about: str) -> list[np.ndarray]:
    data, out = mapped(uri), []
    for part in about.split(","):
        at, n, kind = part.split(":")
        out.append(data[int(at) : int(at) + int(n) * np.dtype(kind).itemsize].view(kind))
    return out


#: Files of the model that this process has mapped; a map costs addresses, neither memory nor a file handle.
_open: dict[str, list[np.ndarray]] = {}


def _cached(uri: str, about: str) -> list[np.ndarray]:
    if uri not in _open:
        _open[uri] = _arrays(uri, about)
    return _open[uri]


class Vocabulary:
    """Hashes of tokens to word numbers, by the sorted hashes of the files; -1 for unknown words.

    What was looked up last for each value of some bits of a hash is at hand in two arrays.
    """

    def __init__(self, files: list[tuple[str, str]], starts: list[int], bits: int):
        self.files, self.starts, self.bits = files, starts, bits
        self.hashes, self.found = np.zeros(CACHED, np.uint64), np.full(CACHED, -1, np.int64)
        self.filled = np.zeros(CACHED, bool)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes & np.uint64(CACHED - 1)).astype(np.int64)
        out = self.found[slot]
        new = np.flatnonzero((self.hashes[slot] != hashes) | ~self.filled[slot])
        if len(new):
            some, which = np.unique(hashes[new], return_inverse=True)
            found = np.full(len(some), -1, np.int64)
            for r, (part, at) in by_range(some, [np.arange(len(some))], self.bits):
                uri, about = self.files[r]
                if uri:
                    place, ok = _found(_cached(uri, about)[0], part)
                    found[at[ok]] = place + self.starts[r]
            out[new] = found[which]
            place = (some & np.uint64(CACHED - 1)).astype(np.int64)
            self.hashes[place], self.found[place], self.filled[place] = some, found, True
        return out


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for the whole model."""

    order: int
    bits: int  # of the ranges of products
    word_bits: int  # of the ranges of hashes
    words: list[tuple[str, str]]  # by range of hashes: hashes, counts
    starts: list[int]  # the first word number of each range, then the number of words
    stats: list[tuple[str, str]]  # by the same ranges: c(h), N1(h), N2(h), N3+(h), N1+(.w)
    pairs: list[tuple[str, str]]  # by range of products: products, counts (of order 3: of words before)
    triples: list[tuple[str, str]]  # by range of products: products, where their stretches start (two arrays), third words (low 16 bits, the others), counts, and sums of heavy products
    tokens: int
    discounts: list[tuple[float, float, float]]  # of words, pairs, triples
    low_total: int
    low_rest: float  # the unigram level's mass for the uniform one

    @property
    def size(self) -> int:
        return self.starts[-1]

    def vocabulary(self) -> Vocabulary:
        def fresh():
            _open.clear()
            return Vocabulary(self.words, self.starts, self.word_bits)

        return kept(("words", repr(self.words[:1]) + repr(self.words[-1:])), fresh)

    def word_stats(self, ids: np.ndarray) -> np.ndarray:
        """c(w), c(h), N1(h), N2(h), N3+(h), N1+(.w) of ascending word numbers, a row each."""
        out = np.zeros((6, len(ids)), np.int64)
        edges = np.searchsorted(ids, self.starts)
        edges[-1] = len(ids)  # the start's number is one past the last word's
        edges[0] = np.searchsorted(ids, 0)
        last = len(self.words) - 1
        for r in range(len(self.words)):
            a, b = edges[r], edges[r + 1]
            if a == b:
                continue
            local = ids[a:b] - self.starts[r]
            if self.words[r][0]:
                counts = _cached(*self.words[r])[1]
                inside = local < len(counts)
                out[0, a:b][inside] = counts[local[inside]]
            if self.stats[r][0]:
                for k, column in enumerate(_cached(*self.stats[r]), 1):
                    inside = local < len(column)
                    out[k, a:b][inside] = column[local[inside]]
            assert r == last or b <= len(ids)
        return out

    def pair_counts(self, products: np.ndarray) -> np.ndarray:
        """Counts of ascending products."""
        out = np.zeros(len(products), np.int64)
        for r, (part, at) in by_range(products, [np.arange(len(products))], self.bits):
            if self.pairs[r][0]:
                keys, counts = _cached(*self.pairs[r])
                place, ok = _found(keys, part)
                out[at[ok]] = counts[place]
        return out

    def triple_counts(self, products: np.ndarray, which: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """c(uvw), c(uv) and the mass left after it, for tokens w after the ascending products of uv, the which-th each."""
        count, total, left = np.zeros(len(which), np.int64), np.zeros(len(products), np.int64), np.ones(len(products))
        range_of = np.full(len(products), -1, np.int32)
        low, high = np.zeros(len(products), np.int64), np.zeros(len(products), np.int64)
        d = self.discounts[2]
        for r, (part, at) in by_range(products, [np.arange(len(products))], self.bits):
            if not self.triples[r][0]:
                continue
            keys, known, steps, _, _, counts, heavy, sums, n1, n2, n3 = _cached(*self.triples[r])
            place, ok = _found(keys, part)
            at = at[ok]
            if not len(at):
                continue
            range_of[at] = r
            first, end = _border(known, steps, place), _border(known, steps, place + 1)
            low[at], high[at] = first, end
            c = np.zeros((4, len(at)), np.int64)
            large = end - first > HEAVY
            j = np.searchsorted(heavy, place[large])
            for row, column in zip(c, (sums, n1, n2, n3), strict=True):
                row[large] = column[j]
            n = (end - first)[~large]
            if len(n):
                before = np.cumsum(n) - n
                seen = counts[np.repeat(first[~large] - before, n) + np.arange(n.sum())].astype(np.int64)
                for row, column in zip(c, (seen, seen == 1, seen == 2, seen > 2), strict=True):
                    row[~large] = np.add.reduceat(column.astype(np.int64), before)
            total[at], left[at] = c[0], (c[1] * d[0] + c[2] * d[1] + c[3] * d[2]) / c[0]
        range_of = range_of[which]
        for r in np.unique(range_of[range_of >= 0]).tolist():
            tail, front, counts = _cached(*self.triples[r])[3:6]
            mine = np.flatnonzero(range_of == r)
            a, b, want = low[which[mine]], high[which[mine]], word[mine]
            limit, active = b.copy(), np.arange(len(mine))
            while len(active):  # each third word by halving its pair's stretch
                middle = (a[active] + b[active]) >> 1
                less = (front[middle].astype(np.uint32) << np.uint32(16) | tail[middle]) < want[active]
                a[active[less]] = middle[less] + 1
                b[active[~less]] = middle[~less]
                active = active[a[active] < b[active]]
            hit = np.flatnonzero(a < limit)
            hit = hit[(front[a[hit]].astype(np.uint32) << np.uint32(16) | tail[a[hit]]) == want[hit]]
            count[mine[hit]] = counts[a[hit]]
        return count, total[which], left[which]


def _border(known: np.ndarray, steps: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Where the stretches at these places start: every so many starts are known, the others stand as steps from them."""
    return known[place >> NEAR].astype(np.int64) + steps[place]


def _found(keys: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in ascending keys of those of part that are there, and which they are."""
    place = np.searchsorted(keys, part)
    ok = place < len(keys)
    ok[ok] = keys[place[ok]] == part[ok]
    return place[ok], ok


def products(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return ((before.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)) * np.uint64(_MIX)


def contexts(ids: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The number before each; start at the head of each text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(lengths) - lengths] = start
    return before


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Chen and Goodman's from the numbers of things seen 1, 2, 3 and 4 times; one half where one is missing."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 and n2 else 0.5, 2 - 3 * y * n3 / n2 if n2 and n3 else 0.5, 3 - 4 * y * n4 / n3 if n3 and n4 else 0.5)
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(raw, 1))


def _discount(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3)]


def range_bits(docs: DataFrame, text: str = "text", range_bytes: int = RANGE_BYTES) -> int:
    """log2 of how many ranges the measured bytes of the texts ask for."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(0, (size - 1) // range_bytes).bit_length()


_SENT = "r int, keys binary, counts binary, more binary"


def _send(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["r", "keys", "counts", "more"])


def _merge(df: DataFrame, one, schema: str, label: str) -> DataFrame:
    """The table of what one() makes of all rows of each r; what it freed goes back to the system."""
    bounded_batches(df.sparkSession)

    def whole(table: pa.Table) -> pa.Table:
        try:
            return one(table)
        finally:
            give_back()

    return materialise(df.groupBy("r").applyInArrow(whole, schema), label)


def _blobs(table: pa.Table, *names: str) -> Iterator[list[bytes]]:
    for row in zip(*(table.column(n) for n in names), strict=True):
        yield [x.as_py() for x in row]


def train(docs: DataFrame, text: str = "text", order: int = ORDER, range_bytes: int = RANGE_BYTES) -> Model:
    """Count all whole texts of docs (null: empty). An empty table gives the uniform model.

    Texts are headed by order - 1 starts. With order 3, counts of pairs and words are those of the
    distinct words before them; pairs with a start count as often as they occur. The number of ranges comes
    from the bytes of the texts. Counts are summed in each map task first, so no frequent word or
    triple is sent more than once a task.
    """
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    spark = docs.sparkSession
    bodies = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    bits = range_bits(bodies, "body", range_bytes)
    word_bits = max(0, bits - (WORD_RANGES - 1).bit_length())
    folder = new_folder(spark, "language-model")

    def count_words(batches):
        parts: list = []

        def out():
            keys, counts = summed(*map(np.concatenate, zip(*parts, strict=True)))
            parts.clear()
            return _send([(r, packed_keys(k), _varied(c), None) for r, (k, c) in by_range(keys, [counts], word_bits)])

        for _, hashes, _ in slices(batches):
            parts.append(np.unique(hashes, return_counts=True))
            if sum(len(k) for k, _ in parts) > MAX_WORDS:
                yield out()
        if parts:
            yield out()

    def merge_words(table: pa.Table) -> pa.Table:
        keys, counts = _merged(table)
        uri, about = _write(folder, "words", [keys, _narrow(counts)])
        return pa.table({"r": table.column("r")[:1], "uri": [uri], "about": [about], "n": [len(keys)], "total": pa.array([int(counts.sum())], pa.int64())})

    made = _merge(map_batches(bodies, count_words, _SENT), merge_words, "r int, uri string, about string, n long, total long", "words")
    got = {row["r"]: row for row in made.collect()}  # a row a range
    drop(made)
    words = _addresses(got, word_bits)
    starts = np.concatenate([[0], np.cumsum([got[r]["n"] if r in got else 0 for r in range(1 << word_bits)])]).tolist()
    tokens, size = sum(row["total"] for row in got.values()), starts[-1]
    if size >= (1 << 32) - 1:
        raise ValueError("more distinct words than 32 bits can number")

    def numbered(batches):
        """Arrays of word numbers and of their texts' lengths, MAX_TOKENS or so at a time."""
        vocabulary = kept(("numbers", folder), lambda: Vocabulary(words, starts, word_bits))
        ids, lengths, n = [], [], 0
        for _, hashes, counts in slices(batches):
            ids.append(vocabulary.numbers(hashes))
            lengths.append(counts)
            n += len(hashes)
            if n > MAX_TOKENS:
                yield np.concatenate(ids), np.concatenate(lengths)
                ids, lengths, n = [], [], 0
        if ids:
            yield np.concatenate(ids), np.concatenate(lengths)

    def count_pairs(batches):
        for ids, lengths in numbered(batches):
            keys, counts = np.unique(products(contexts(ids, lengths, size), ids), return_counts=True)
            yield _send([(r, packed_keys(k), _varied(c), None) for r, (k, c) in by_range(keys, [counts], bits)])

    def count_triples(batches):
        for ids, lengths in numbered(batches):
            before = contexts(ids, lengths, size)
            keys, at = np.unique(products(contexts(before, lengths, size), before), return_inverse=True)
            both, counts = np.unique((at.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64), return_counts=True)
            del before, at
            fans = np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=len(keys))
            third, ends = (both & np.uint64(0xFFFFFFFF)).astype(np.uint64), np.concatenate([[0], np.cumsum(fans)])
            rows, done = [], 0
            for r, (k, f) in by_range(keys, [fans], bits):
                a, b = ends[done], ends[done + len(k)]
                done += len(k)
                rows.append((r, packed_keys(k), _varied(f) + _varied(counts[a:b]), planes(third[a:b])))
            yield _send(rows)

    def merge_triples(table: pa.Table) -> pa.Table:
        keys, fans, counts, third = [], [], [], []
        for blob, numbers, more in _blobs(table, "keys", "counts", "more"):
            keys.append(unpacked_keys(blob))
            n = len(keys[-1])
            fans.append(_plain(numbers, n))
            counts.append(_plain(numbers[1 + numbers[0] * n :]))
            third.append(unplaned(more))
        keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        both = (np.repeat(at.astype(np.uint64), np.concatenate(fans)) << np.uint64(32)) | np.concatenate(third)
        both, counts = summed(both, np.concatenate(counts))
        del at, third
        n = np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=len(keys))
        third, first = (both & np.uint64(0xFFFFFFFF)).astype("<u4"), np.cumsum(n) - n
        heavy = np.flatnonzero(n > HEAVY)
        sums = [np.add.reduceat(x.astype(np.int64), first)[heavy] for x in (counts, counts == 1, counts == 2, counts > 2)]
        borders = np.append(first, len(third))
        known = borders[:: 1 << NEAR].astype("<u4")
        steps = borders - np.repeat(known, 1 << NEAR)[: len(borders)]
        words = [(third & np.uint32(0xFFFF)).astype("<u2"), _narrow(third >> np.uint32(16))]
        uri, about = _write(folder, "triples", [keys, known, _narrow(steps), *words, _narrow(counts), heavy.astype("<u4"), *map(_narrow, sums)])
        return pa.table({"r": table.column("r")[:1], "uri": [uri], "about": [about], **{f"n{k}": pa.array([int((counts == k).sum())], pa.int64()) for k in (1, 2, 3, 4)}})

    def pairs_of_triples(batches):
        """(v, w) of the triples of each file: how many words stand before, or how often it heads a text."""
        for batch in batches:
            for row in batch.to_pylist():
                keys, known, steps, tail, front, counts, *_ = _arrays(row["uri"], row["about"])
                third = front.astype(np.uint32) << np.uint32(16) | tail
                back = keys * np.uint64(_BACK)
                second = np.repeat((back & np.uint64(0xFFFFFFFF)).astype(np.int64), np.diff(_border(known, steps, np.arange(len(keys) + 1))))
                found, n = summed(products(second, third), np.where(second == size, counts.astype(np.int64), 1))
                for rows in _chunked([(r, packed_keys(k), _varied(c), None) for r, (k, c) in by_range(found, [n], bits)]):
                    yield _send(rows)

    headed = "r int, uri string, about string, n1 long, n2 long, n3 long, n4 long"
    add = lambda rows, k: sum(row[k] for row in rows.values())
    kinds = lambda rows: discounts([add(rows, f"n{k}") for k in (1, 2, 3, 4)])
    triples, top = _addresses({}, bits), (0.0, 0.0, 0.0)
    if order == 3:
        made = _merge(map_batches(bodies, count_triples, _SENT), merge_triples, headed, "triples")
        heads = {row["r"]: row for row in made.collect()}  # a row a range
        triples, top = _addresses(heads, bits), kinds(heads)
        files = spark.createDataFrame([(r, *a) for r, a in enumerate(triples) if a[0]], "r int, uri string, about string")
        counted = map_batches(files.repartitionByRange(max(1, len(heads)), "r"), pairs_of_triples, _SENT)
        drop(made)
    else:
        counted = map_batches(bodies, count_pairs, _SENT)

    def merge_pairs(table: pa.Table) -> pa.Table:
        r = table.column("r")[0].as_py()
        keys, counts = _merged(table)
        uri, about = _write(folder, "pairs", [keys, _narrow(counts)])
        both = keys * np.uint64(_BACK)
        before, word = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        del both, keys
        ids, at = np.unique(before, return_inverse=True)
        sums = [np.bincount(at, c, len(ids)).astype(np.int64) for c in (counts, counts == 1, counts == 2, counts > 2)]
        ends, fans = np.unique(word, return_counts=True)
        rows = [(r, -1, uri, about, *[int((counts == k).sum()) for k in (1, 2, 3, 4)], *[None] * 7)]
        # what the ranges of words need to know of these
        a, b = np.searchsorted(ids, starts), np.searchsorted(ends, starts)
        a[-1], b[-1] = len(ids), len(ends)  # the start's number stands after the last word's
        for v in range(1 << word_bits):
            if a[v] < a[v + 1] or b[v] < b[v + 1]:
                mine, its = slice(a[v], a[v + 1]), slice(b[v], b[v + 1])
                numbers = [packed_keys((x - starts[v]).astype(np.uint64)) for x in (ids[mine], ends[its])]
                rows.append((r, v, "", "", 0, 0, 0, 0, numbers[0], *[_varied(s[mine]) for s in sums], numbers[1], _varied(fans[its])))
        names = ["r", "v", "uri", "about", "n1", "n2", "n3", "n4", "h", "c", "k1", "k2", "k3", "w", "f"]
        types = [pa.int32(), pa.int32(), pa.string(), pa.string(), *[pa.int64()] * 4, *[pa.binary()] * 7]
        return pa.table([pa.array(col, k) for col, k in zip(zip(*rows, strict=True), types, strict=True)], names)

    merged = headed.replace("r int", "r int, v int") + ", h binary, c binary, k1 binary, k2 binary, k3 binary, w binary, f binary"
    made = _merge(counted, merge_pairs, merged, "pairs")
    heads = {row["r"]: row for row in made.filter("v = -1").select("r", "uri", "about", "n1", "n2", "n3", "n4").collect()}

    def merge_stats(table: pa.Table) -> pa.Table:
        v = table.column("r")[0].as_py()
        n = starts[v + 1] - starts[v] + (v + 1 == len(words))
        out = [np.zeros(n, np.int64) for _ in range(5)]
        for h, *sums, w, f in _blobs(table, "h", "c", "k1", "k2", "k3", "w", "f"):
            h, w = unpacked_keys(h).astype(np.int64), unpacked_keys(w).astype(np.int64)
            for column, x in zip(out, sums, strict=False):
                column[h] += _plain(x)
            out[4][w] += _plain(f)
        uri, about = _write(folder, "stats", [_narrow(a) for a in out])
        low = out[4]
        values = {**{f"n{k}": int((low == k).sum()) for k in (1, 2, 3, 4)}, "more": int((low > 2).sum()), "total": int(low.sum())}
        return pa.table({"r": table.column("r")[:1], "uri": [uri], "about": [about], **{k: pa.array([x], pa.int64()) for k, x in values.items()}})

    parts = made.filter("v >= 0").select(F.col("v").alias("r"), "h", "c", "k1", "k2", "k3", "w", "f")
    told = _merge(parts, merge_stats, headed + ", more long, total long", "stats")
    lows = {row["r"]: row for row in told.collect()}
    drop(made, told)
    low, total = kinds(lows), add(lows, "total")
    rest = (low[0] * add(lows, "n1") + low[1] * add(lows, "n2") + low[2] * add(lows, "more")) / total if total else 1.0
    return Model(order, bits, word_bits, words, starts, _addresses(lows, word_bits), _addresses(heads, bits), triples, tokens, [low, kinds(heads), top], total, rest)


def _addresses(rows: dict, bits: int) -> list[tuple[str, str]]:
    return [(rows[r]["uri"], rows[r]["about"]) if r in rows else ("", "") for r in range(1 << bits)]


def _chunked(rows: list[tuple], most: int = 64) -> Iterator[list[tuple]]:
    for at in range(0, len(rows), most):
        yield rows[at : at + most]


def _varied(counts: np.ndarray) -> bytes:
    """Counts with a byte before that says their width."""
    slim = _narrow(counts)
    return bytes([slim.itemsize]) + slim.tobytes()


def _plain(data: bytes, n: int = -1) -> np.ndarray:
    """All or the first n counts of _varied()."""
    return np.frombuffer(data, f"<u{data[0]}", n, 1).astype(np.int64)


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = zip(*((unpacked_keys(k), _plain(c)) for k, c in _blobs(table, "keys", "counts")), strict=True)
    return summed(np.concatenate(keys), np.concatenate(counts))


def log10_probabilities(model: Model, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the model's probability of each word number after those before it in its text, and the words' counts."""
    heads = np.cumsum(lengths) - lengths
    before = contexts(ids, lengths, model.size)
    some, word = np.unique(np.append(ids, model.size), return_inverse=True)
    own = model.word_stats(some)
    own[:, some < 0] = 0
    own[0, some == model.size] = 0
    word, start = word[:-1], word[-1]
    head = contexts(word, lengths, start)
    low = np.full(len(some), model.low_rest / (model.size + 1))
    if model.low_total:
        low += np.maximum(own[5] - _discount(own[5], model.discounts[0]), 0) / model.low_total
    context, d = own[1], model.discounts[1]
    left = np.divide(own[2] * d[0] + own[3] * d[1] + own[4] * d[2], context, out=np.ones(len(some)), where=context > 0)
    # unknown words have a number that none has; the last product is that of two starts
    absent = (1 << 32) - 1
    known = lambda x: np.where(x >= 0, x, absent)
    pairs = np.append(products(known(before), known(ids)), products(np.array([model.size]), np.array([model.size])))
    keys, pair = np.unique(pairs, return_inverse=True)
    c = model.pair_counts(keys)[pair[:-1]]
    out = np.divide(np.maximum(c - _discount(c, d), 0), context[head], out=np.zeros(len(ids)), where=c > 0) + left[head] * low[word]
    if model.order == 3:
        # the two words before a token are the pair of the token before it
        first = np.empty(len(ids), np.int64)
        first[1:] = pair[:-2]
        first[heads] = pair[-1]
        c, total, left = model.triple_counts(keys, first, known(ids).astype(np.uint32))
        out = np.divide(np.maximum(c - _discount(c, model.discounts[2]), 0), total, out=np.zeros(len(ids)), where=c > 0) + left * out
    return np.log10(out), own[0][word]


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, n_known, base_score (add-0.1 unigrams) and score of every whole text.

    A null or empty text is its end alone. The arrays stay in files that workers map.
    """

    def run(batches):
        vocabulary = model.vocabulary()
        floor = np.log10(model.tokens + 0.1 * (model.size + 1))
        for part, hashes, lengths in slices(batches):
            ids = vocabulary.numbers(hashes)
            logs, counts = log10_probabilities(model, ids, lengths)
            at = np.cumsum(lengths) - lengths
            base = np.add.reduceat(np.log10(counts + 0.1) - floor, at)
            known = np.add.reduceat((counts > 0).astype(np.int64), at)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lengths), pa.array(known), pa.array(base), pa.array(np.add.reduceat(logs, at))], ["id", "n_tokens", "n_known", "base_score", "score"]
            )

    bodies = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    return map_batches(bodies, run, "id long, n_tokens long, n_known long, base_score double, score double")
