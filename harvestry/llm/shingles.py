"""Sets of five-word shingles as sorted 63-bit tokens, rare ones first."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from harvestry.llm.hashing import Hasher, stirred

WORDS = 5
#: Bytes of text shingled at once.
SLICE_BYTES = 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 56) - 1)
#: The rarity of a word that the table of frequent ones doesn't have.
RARE = 24


class Shingler:
    """Turns texts into arrays of distinct tokens, a batch at a time.

    A token's top bit is free; then come seven bits that are small if its words are rare, then 56
    bits of a hash of the words. Rarity comes from a table of frequent words; whatever that table
    says, equal shingles have equal tokens, so it only steers which tokens come first.
    """

    def __init__(self, frequent: dict[bytes, int]):
        self.hasher = Hasher()
        words = sorted((int(self.hasher.tokens(pa.array([w], pa.binary()))[0][0]), r) for w, r in frequent.items())
        self.words, self.rarities = np.array([h for h, _ in words], np.uint64), np.array([r for _, r in words] + [RARE], np.int64)

    def batch(self, body: pa.Array) -> list[np.ndarray]:
        """Each text's ascending distinct tokens (null: none); fewer than five words are one shingle, none are no shingle."""
        whole, out, at = pa.array([t.as_py() or b"" for t in body], pa.binary()) if body.null_count else body, [], 0
        ends = np.frombuffer(whole.buffers()[1], np.int32, len(whole) + 1, 4 * whole.offset).astype(np.int64) if len(whole) else np.zeros(1, np.int64)
        while at < len(whole):  # SLICE_BYTES at a time, or a longer text
            end = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1)
            out += self._slice(whole.slice(at, end - at))
            at = end
        return out

    def _slice(self, whole: pa.Array) -> list[np.ndarray]:
        hashes, counts = self.hasher.tokens(whole)
        ends = np.cumsum(counts)
        h = np.delete(hashes, ends - 1)
        counts, starts = counts - 1, ends - counts - np.arange(len(counts))
        if not len(h):
            return [np.empty(0, np.int64)] * len(counts)
        at = np.searchsorted(self.words, h)
        at[at == len(self.words)] = 0
        known = self.words[at] == h if len(self.words) else np.zeros(len(h), bool)
        rare = np.concatenate([[0], np.cumsum(self.rarities[np.where(known, at, len(self.words))])])

        def tokens(first: int, n: int, width: int) -> np.ndarray:
            out = np.full(n, width, np.uint64)
            for k in range(width):
                out = out * _STEP + h[first + k : first + k + n]
            top = (127 - np.minimum(rare[first + width : first + width + n] - rare[first : first + n], 127)).astype(np.uint64)
            return ((stirred(out) & _LOW) | (top << np.uint64(56))).astype(np.int64)

        full = tokens(0, len(h) - WORDS + 1, WORDS) if len(h) >= WORDS else np.empty(0, np.int64)
        return [
            np.unique(full[s : s + c - WORDS + 1]) if c >= WORDS else tokens(s, 1, c) if c else np.empty(0, np.int64) for s, c in zip(starts.tolist(), counts.tolist(), strict=True)
        ]

    def tokens(self, text: bytes | None) -> np.ndarray:
        return self.batch(pa.array([text], pa.binary()))[0]


#: The least and most bits of a sketch; sets of more tokens than a sketch has bits have one of twice the bits, and so on.
LEAST_BITS, MOST_BITS = 512, 1 << 16


def parity_sketch(tokens: np.ndarray) -> bytes:
    """A bit for each class of tokens: whether the set has an odd number of them.

    Every token that only one of two sets has flips one bit, so their sketches differ in at most
    as many bits as the sets differ in tokens. A longer sketch folds into a shorter one.
    """
    bits = LEAST_BITS
    while bits < min(2 * len(tokens), MOST_BITS):
        bits *= 2
    return np.packbits((np.bincount(tokens & (bits - 1), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, words: int) -> np.ndarray:
    """A sketch in so many 64-bit words, at most those that it has."""
    out = np.frombuffer(sketch, np.uint64)
    while len(out) > words:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def may_be_similar(sizes: np.ndarray, sketches: list[bytes], percent: int = 80, parts: np.ndarray | None = None) -> np.ndarray:
    """For each set whether some other may reach the similarity, by sizes and sketches.

    With parts, only pairs of a part 0 and a part 1 count. No pair that reaches it is missed: such
    sets differ in at most (100 - percent) / (100 + percent) of the sum of their sizes. Sets are
    compared within classes of sketch lengths, each with those of its own and of the next lengths
    that sizes allow, folded to the shorter.
    """
    order = np.argsort(sizes, kind="stable")
    n = np.asarray(sizes)[order]
    words = np.array([len(sketches[i]) // 8 for i in order])
    side = None if parts is None else np.asarray(parts)[order]
    out = np.zeros(len(n), bool)
    ends = np.searchsorted(n, 100 * n // percent, "right")
    for width in np.unique(words):
        mine = np.flatnonzero(words == width)  # consecutive, as longer sketches are of larger sets
        first, last = mine[0], ends[mine[-1]]
        rows = np.array([folded(sketches[order[k]], width) for k in range(first, last)])
        for i in mine:
            rest = slice(i + 1, ends[i])
            differ = np.bitwise_count(rows[i + 1 - first : ends[i] - first] ^ rows[i - first]).sum(axis=1, dtype=np.int64)
            near = differ * (100 + percent) <= (n[rest] + n[i]) * (100 - percent)
            if side is not None:
                near &= side[rest] != side[i]
            if near.any():
                out[i] = True
                out[rest] |= near
    back = np.empty(len(n), bool)
    back[order] = out
    return back


def prefix_length(n: int, percent: int = 80) -> int:
    """How many first tokens a set of n must show so that any set similar enough shares one of them."""
    return n + (-percent * n // 100) + 1 if n else 0
