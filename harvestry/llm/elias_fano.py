"""Elias-Fano coded monotone sequences in numpy."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Every so many values, the place of one is written down, so that select scans few bytes.
SAMPLE = 256
#: Values coded at once; a multiple of 8, so that each step's low bits end with a byte.
_STEP = 1 << 15


class EliasFano:
    """A non-decreasing sequence of integers from 0 in about 2 + log2(universe / n) bits a value.

    The low bits stand packed; the high bits are unary in a bit vector in which the i-th set bit
    sits at high(i) + i. Both selects, of one value and of a run of them, start at the nearest
    sampled place and unpack no more than they return.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values)
        n, top = len(values), int(values[-1]) if len(values) else 0
        return cls.stream(n, top, (values[i : i + _STEP] for i in range(0, n, _STEP)))

    @classmethod
    def stream(cls, n: int, top: int, parts: Iterable[np.ndarray]) -> EliasFano:
        """Code n values, the last one top, that come in parts of _STEP (the last may be shorter)."""
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.zeros((n * low_bits + 7) // 8, np.uint8)
        high = np.zeros(((top >> low_bits) + n + 7) // 8 if n else 0, np.uint8)
        samples = np.zeros(-(-n // SAMPLE), "<u8")
        at, last = 0, 0
        for part in parts:
            part = np.asarray(part, np.int64)
            if not len(part):
                continue
            if part[0] < last or np.any(np.diff(part) < 0):
                raise ValueError("values must be from 0 and must not decrease")
            bits = ((part[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8)
            packed = np.packbits(bits.ravel(), bitorder="little")
            start = at * low_bits // 8
            low[start : start + len(packed)] = packed
            ones = (part >> low_bits) + np.arange(at, at + len(part))
            np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
            first = -at % SAMPLE
            samples[(at + first) // SAMPLE :][: len(ones[first::SAMPLE])] = ones[first::SAMPLE]
            at, last = at + len(part), int(part[-1])
        if at != n or last != top:
            raise ValueError("not as many values, or another last one, as was said")
        return cls(n, low_bits, low, high, samples)

    def parts(self) -> list[np.ndarray]:
        return [self.low, self.high, self.samples]

    @classmethod
    def of(cls, n: int, low_bits: int, parts: list[np.ndarray]) -> EliasFano:
        low, high, samples = parts
        return cls(n, low_bits, low, high, samples.view("<u8"))

    def get(self, i: int) -> int:
        """The i-th value, reading only its own bits and those since the last sample."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, skip = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        head = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (ones := head.bit_count()) <= skip:
            skip -= ones
            byte += 1
            head = int(self.high[byte])
        for _ in range(skip):
            head &= head - 1
        place = byte * 8 + (head & -head).bit_length() - 1
        start = i * self.low_bits
        raw = int.from_bytes(self.low[start // 8 : (start + self.low_bits + 7) // 8].tobytes(), "little")
        return (place - i) << self.low_bits | raw >> start % 8 & (1 << self.low_bits) - 1

    def run(self, i: int, j: int) -> np.ndarray:
        """The values from i to before j, selected together: j - i of them are unpacked, and those
        between the samples around them."""
        if not 0 <= i <= j <= self.n:
            raise IndexError((i, j))
        if i == j:
            return np.empty(0, np.int64)
        first = i // SAMPLE
        begin = int(self.samples[first]) // 8
        after = -(-j // SAMPLE)
        end = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        # the byte of the sample may hold ones of values before it
        ones = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")) + 8 * begin
        ones = ones[np.searchsorted(ones, int(self.samples[first])) + i - first * SAMPLE :][: j - i]
        values = (ones - np.arange(i, j)) << self.low_bits
        if self.low_bits:
            start = i * self.low_bits
            bits = np.unpackbits(self.low[start // 8 : (j * self.low_bits + 7) // 8], bitorder="little")[start % 8 :][: (j - i) * self.low_bits]
            values = values | bits.reshape(j - i, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return values
