"""Fill-in-middle examples: texts cut at two ranked units and put together again in another order.

A unit is found by big integers, a bit for each byte of the text: bytes.translate() makes the mask of
a class of bytes, shifts and boolean operations on masks mark where units begin, bit_count() says how
many there are, and the place of the n-th is found by halving the mask again and again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.samples import free_names
from harvestry.llm.workers import map_batches

#: What marks the parts of an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _class(members: Iterable[int]) -> bytes:
    """A table for bytes.translate(): "1" for members, "0" for all other bytes."""
    found = set(members)
    return bytes(49 if b in found else 48 for b in range(256))


#: Bytes that go on with a code point, white space, and line ends.
_CONTINUES, _SPACE, _LINE_END = _class(range(0x80, 0xC0)), _class([0x20, *range(0x09, 0x0E)]), _class([0x0A])


def mask(body: bytes, table: bytes) -> int:
    """A number whose bit i is set where byte i of body is of the table's class."""
    return int(body.translate(table)[::-1], 2) if body else 0


def code_points(body: bytes) -> int:
    """The bytes that begin a code point; the first byte always does."""
    return (~mask(body, _CONTINUES) & _all(body)) | (1 if body else 0)


def words(body: bytes) -> int:
    """The bytes that begin a word, which goes on to the next one; white space before all words is a unit of its own."""
    solid = ~mask(body, _SPACE) & _all(body)
    return (solid & ~(solid << 1)) | (1 if body else 0)


def lines(body: bytes) -> int:
    """The bytes that begin a line, its line end included."""
    return ((mask(body, _LINE_END) << 1) & _all(body)) | (1 if body else 0)


def _all(body: bytes) -> int:
    return (1 << len(body)) - 1


UNITS: dict[str, Callable[[bytes], int]] = {"code_point": code_points, "word": words, "line": lines}


def select(bits: int, rank: int, width: int) -> int:
    """The place of the set bit of this rank (from 0) among the lowest width bits; width if there are no more than rank.

    Each step looks at half of what the step before looked at, so all of them together cost as much
    as one pass over the mask.
    """
    if rank >= bits.bit_count():
        return width
    low = 0
    while width > 1:
        half = width >> 1
        lower = bits & ((1 << half) - 1)
        here = lower.bit_count()
        if rank < here:
            bits, width = lower, half
        else:
            bits, width, low, rank = bits >> half, width - half, low + half, rank - here
    return low


def cut(body: bytes, starts: int, units: int, first: int, second: int) -> tuple[bytes, bytes, bytes]:
    """body before unit `first`, from there to before unit `second`, and the rest; 0 <= first <= second <= units."""
    size = len(body)
    a = size if first >= units else select(starts, first, size)
    b = size if second >= units else a if second == first else select(starts, second, size)
    return body[:a], body[a:b], body[b:]


@dataclass(frozen=True)
class Recipe:
    """How texts become examples: shares in percent, the unit of the cuts and what seeds them."""

    seed: int = 1
    plain_percent: int = 10
    spm_percent: int = 20
    unit: str = "code_point"


def _draws(key: Column, seed: int) -> list[Column]:
    """Four numbers under 2^32 that depend on the seed and the key only: the groups of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


_OUT = "n long, form string, prefix_units long, middle_units long, output string"


def transform(docs: DataFrame, recipe: Recipe = Recipe(), key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """row (a struct of the columns to carry, or of all of docs), n, form, prefix_units, middle_units, output: a row for each of docs.

    n is the number of units of the whole text. The cuts are ranks from the key's draws; form is
    plain where the text is empty, holds one of the marks (so that every output can be taken apart
    again) or falls into the plain share; there output is the text, and the units are null.
    A null text is an empty one; a null key draws as an empty key does; equal keys cut at the same
    draws, so repeated rows give repeated outputs. Very long texts cost time and memory in
    proportion. Columns of docs stay inside row, so none can clash. No rows give none.
    """
    if recipe.unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}")
    row = F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row")
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body")
    given = docs.select(row, body, *[h.alias(f"h{i}") for i, h in enumerate(_draws(F.col(f"`{key}`"), recipe.seed))])
    schema = f"row {given.schema['row'].dataType.simpleString()}, {_OUT}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(1, 6)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_examples(recipe, *columns)], ["row", "n", "form", "prefix_units", "middle_units", "output"])

    return map_batches(given, run, schema)


_MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]


def example(recipe: Recipe, body: bytes, h: tuple[int, int, int, int]) -> tuple:
    """n, form, units of the prefix and of the middle, output."""
    starts = UNITS[recipe.unit](body)
    n = starts.bit_count()
    if not body or h[2] % 100 >= 100 - recipe.plain_percent or any(m in body for m in _MARKS):
        return n, PLAIN, None, None, body
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = cut(body, starts, n, first, second)
    p, s, m = _MARKS
    if h[3] % 100 < recipe.spm_percent:
        return n, SPM, first, second - first, b"".join((s, suffix, p, prefix, m, middle))
    return n, PSM, first, second - first, b"".join((p, prefix, s, suffix, m, middle))


def _examples(recipe: Recipe, bodies: list, *draws: list) -> list[pa.Array]:
    n, form, prefix, middle, output = [], [], [], [], []
    for body, *h in zip(bodies, *draws, strict=True):
        for column, value in zip((n, form, prefix, middle, output), example(recipe, body, h), strict=True):
            column.append(value)
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
    # bytes that aren't valid UTF-8 pass as they came
    texts = pa.Array.from_buffers(pa.string(), len(output), pa.array(output, pa.binary()).buffers())
    return [*(pa.array(c, k) for c, k in zip((n, form, prefix, middle), kinds, strict=True)), texts]


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of: its parts found by their marks and put in order."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What stands after the mark `first`, after `second`, and after the mark of the middle."""
        rest = F.substring(output, F.lit(len(first) + 1), F.length(output))
        a = F.substring_index(rest, second, 1)
        after = F.substring(rest, F.length(a) + len(second) + 1, F.length(rest))
        b = F.substring_index(after, MIDDLE, 1)
        return a, b, F.substring(after, F.length(b) + len(MIDDLE) + 1, F.length(after))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    return F.when(form == PSM, psm).when(form == SPM, F.concat(prefix, middle, suffix)).otherwise(output)


def with_examples(docs: DataFrame, recipe: Recipe = Recipe(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with form and output beside its columns; names that docs has already get underscores before them."""
    form, output = free_names(docs, "form", "output")
    return transform(docs, recipe, key, text).select("row.*", F.col("form").alias(form), F.col("output").alias(output))
