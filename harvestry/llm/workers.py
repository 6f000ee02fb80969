"""Python workers: byte-bounded Arrow batches, and what a process keeps from task to task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch on its way to a worker (a single longer row is a batch of its own).
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

_kept: dict[Hashable, Any] = {}


#: Small things that stay whatever else is kept.
_beside: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any], beside: bool = False) -> Any:
    """What make() gave for key in this process; whatever was kept for another key is let go first, unless this is one to stay beside others."""
    there = _beside if beside else _kept
    if key not in there:
        if not beside:
            _kept.clear()
            _beside.clear()
        there[key] = make()
    return there[key]


def bounded_batches(spark: SparkSession) -> None:
    """Hold the session to batches of at most BATCH_BYTES; a lower limit of its own stays."""
    now = spark.conf.get(_BATCH_LIMIT).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow with byte-bounded batches; what a task freed goes back to the system at its end."""
    bounded_batches(df.sparkSession)

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def give_back() -> None:
    """Return freed memory of this process to the system, so that stages don't add up."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library keeps its own house
