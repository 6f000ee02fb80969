"""Session defaults shared by the command line, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What every result assumes; the rest is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS and, keyed with ``__`` for dots, any further ones."""
    builder = SparkSession.builder.appName("harvestry")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in more.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes of an Arrow batch on its way to a Python worker, whatever the length of its texts (a longer row is a batch of its own).
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Hold the session to batches of at most BATCH_BYTES; a lower limit of its own stays."""
    now = spark.conf.get(_BATCH_LIMIT).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))
