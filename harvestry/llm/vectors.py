"""Vectors of floats as vectors of integers, and their way between Spark and numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Squared lengths up to this keep every inner product and squared distance inside a long.
MOST_SQUARED = float(1 << 60)
#: Up to this, products of floats are exact, so that they may be made by the faster routine.
EXACT = float(1 << 50)


def quantised(rows: DataFrame, scale: int, key: str, vector: str, components: int | None = None) -> DataFrame:
    """(id long, v array<int>): floor(scale * x) of every component x, as a double.

    Vectors that are null or hold a null, NaN or infinite component are left out, and so are those
    of another number of components, if that is given, and those whose squared length after scaling
    is over MOST_SQUARED, as results wouldn't fit a long. Other columns aren't read.
    """
    raw = F.col(f"`{vector}`")
    scaled = lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < MOST_SQUARED))
    length = F.aggregate(raw, F.lit(0.0), lambda s, x: s + scaled(x).cast("double") * scaled(x).cast("double"))
    good = raw.isNotNull() & finite & (length <= MOST_SQUARED)
    if components is not None:
        good = (F.size(raw) == components) & good
    return rows.filter(good).select(F.col(f"`{key}`").cast("long").alias("id"), F.transform(raw, lambda x: scaled(x).try_cast("int")).alias("v"))


def self_product(v: Column) -> Column:
    return F.aggregate(v, F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))


def matrix(lists: pa.Array) -> np.ndarray:
    """An int64 matrix of lists of ints; shorter ones end in zeros."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    sizes, flat = np.diff(ends), lists.values.to_numpy(zero_copy_only=False)
    most = int(sizes.max()) if len(sizes) else 0
    if most and (sizes == most).all():
        return flat[ends[0] : ends[-1]].reshape(-1, most).astype(np.int64)
    out = np.zeros((len(sizes), most), np.int64)
    for i in np.flatnonzero(sizes):
        out[i, : sizes[i]] = flat[ends[i] : ends[i + 1]]
    return out


def padded(x: np.ndarray, dims: int) -> np.ndarray:
    """x with exactly dims columns: zeros after it, or cut."""
    return x[:, :dims] if x.shape[1] >= dims else np.pad(x, ((0, 0), (0, dims - x.shape[1])))


def packed(x: np.ndarray) -> bytes:
    """Integers as little-endian bytes, of two bytes each if they fit, else of four; unpacked() needs their number."""
    small = not x.size or (x.min() >= -(1 << 15) and x.max() < 1 << 15)
    return np.ascontiguousarray(x, "<i2" if small else "<i4").tobytes()


def unpacked(data: bytes, count: int, dims: int) -> np.ndarray:
    """The int64 matrix of count rows that packed() gave."""
    kind = "<i2" if len(data) == 2 * count * dims else "<i4"
    return np.frombuffer(data, kind).reshape(count, dims).astype(np.int64)


def chunks(batches, most_rows: int, most_bytes: int):
    """(ids, matrix) of batches (id, v), of at most so many rows or bytes of four-byte integers together."""
    held: list[tuple[list, np.ndarray]] = []
    rows = dims = 0

    def whole():
        width = max(x.shape[1] for _, x in held)
        return [i for ids, _ in held for i in ids], np.concatenate([padded(x, width) for _, x in held])

    for batch in batches:
        ids, lists, at = batch.column(0).to_pylist(), batch.column(1), 0
        while at < len(ids):
            width = max(dims, max(1, int(np.diff(lists.offsets.to_numpy()).max())))
            room = max(1, min(most_rows, most_bytes // (4 * width)))
            if held and rows >= room:
                yield whole()
                held, rows, dims = [], 0, 0
                continue
            n = min(room - rows, len(ids) - at)
            part = matrix(lists.slice(at, n)) if n < len(ids) else matrix(lists)
            held.append((ids[at : at + n], part))
            rows, dims, at = rows + n, max(dims, part.shape[1]), at + n
    if held:
        yield whole()
