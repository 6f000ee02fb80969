"""Tables that cut lineage: written to the shared folder of the cluster and read again.

A written table survives lost executors, which a persisted or locally checkpointed one does not,
and it is columnar, so later steps still read only what they need.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used where the session names no folder and everything runs on one machine, as in tests.
DEFAULT_DIR = "file:///tmp/checkpoints"
#: Shuffle files of a finished write go at once: what it wrote takes their place.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: So many rows at most are few ones.
FEW_ROWS = 20_000

_made: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; DEFAULT_DIR only where it is unset and the master is local.

    On a cluster a machine-local folder would hold each executor's part on its own disk, so a
    session there must name one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        found = DEFAULT_DIR
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under shared_dir(); drop(), discard() or the session's end removes it."""
    path = f"{shared_dir(spark)}/harvestry-{uuid.uuid4().hex}/{label}"
    _made[path.rsplit("/", 1)[0]] = spark
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._harvestry_folder = path.rsplit("/", 1)[0]
    return out


def sized(rows: DataFrame, count: int | None = None) -> DataFrame:
    """rows, which the next join broadcasts if they are few (count, or that of a written table), and merges else.

    Spark goes by the sizes of compressed files, and knows none of the roster and of what is joined
    with it. So beside these it broadcasts a table of 10 MB on disk, which may be hundreds in memory.
    """
    return F.broadcast(rows) if (rows.count() if count is None else count) <= FEW_ROWS else rows.hint("merge")


def drop(*tables: DataFrame | str) -> None:
    """Remove tables of materialise(), or folders of new_folder(), that nothing will read again."""
    for table in tables:
        folder = table.rsplit("/", 1)[0] if isinstance(table, str) else table._harvestry_folder
        if (spark := _made.pop(folder, None)) is not None:
            _delete(spark, folder)


def discard() -> None:
    """Remove all folders made so far; results that read them must have been consumed."""
    while _made:
        folder, spark = _made.popitem()
        try:
            _delete(spark, folder)
        except Exception:  # noqa: BLE001  the session may be gone already
            return


def _delete(spark: SparkSession, folder: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


atexit.register(discard)
