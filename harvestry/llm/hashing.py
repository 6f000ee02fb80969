"""Words of whole batches of texts as 64-bit hashes, by arrays: no object a word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash


def stirred(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits under which neighbouring values part (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Bytes whose sums are taken at once.
CHUNK = 1 << 20


class Hasher:
    """Texts to the 64-bit hashes of their tokens, by arrays of whole batches: no object a word.

    A word's hash is a polynomial of random numbers, one for each byte value, stirred at the end:
    sums from the start of the batch give that of each stretch, and the inverse power moves it to
    the front. A-Z count as lower case; words end at [\\x20\\x09-\\x0D] and with their text; each text
    ends with a token of its own.
    """

    BASE = 0xD6E8FEB86659FD93  # odd, so that its powers have inverses

    def __init__(self):
        numbers = [xxhash.xxh64_intdigest(bytes([b]), 77) for b in range(256)]
        lower = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
        self.number = np.array([numbers[b] for b in lower], np.uint64)
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.end = stirred(self.number[10:11])[0]
        self.power = self.back = np.empty(0, np.uint64)

    def tokens(self, body: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of a binary column without nulls, one text after the other, and each text's number of them."""
        offsets = np.frombuffer(body.buffers()[1], np.int32, len(body) + 1, 4 * body.offset).astype(np.int64)
        raw = np.frombuffer(body.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        n = len(raw)
        word = ~self.space[raw]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        heads = offsets[:-1][offsets[:-1] < n]
        begins[heads] = word[heads]
        # a word that goes on to a text's end stops there too, though another text begins right after it
        stops = word.copy()
        stops[:-1] &= ~word[1:] | begins[1:]
        first, last = np.flatnonzero(begins), np.flatnonzero(stops)
        hashes, i = np.empty(len(first), np.uint64), 0
        while i < len(first):  # words of CHUNK bytes at a time, or a longer one
            j = max(i + 1, int(np.searchsorted(last, first[i] + CHUNK)))
            start, n = first[i], last[j - 1] + 1 - first[i]
            if n > len(self.power):
                self.power, self.back = _powers(max(n, CHUNK), self.BASE), _powers(max(n, CHUNK), pow(self.BASE, -1, 1 << 64))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(self.number[raw[start : start + n]] * self.power[:n], dtype=np.uint64)])
            a, b = first[i:j] - start, last[i:j] + 1 - start
            hashes[i:j] = stirred((sums[b] - sums[a]) * self.back[a])
            i = j
        counts = np.diff(np.searchsorted(first, offsets))
        out = np.full(len(hashes) + len(counts), self.end, np.uint64)
        out[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes
        return out, counts + 1
