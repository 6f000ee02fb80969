"""Token-id files: one array of ids after another, with Elias-Fano coded document boundaries.

A file holds, in this order: the ids of all its documents; the document ids (int64) and a bit for
each that says whether it is null; the low bits, high bits and samples of the boundaries; a JSON
footer with counts and offsets; its length (uint32) and MAGIC. Files of a corpus follow each other
in ascending document id; the manifest names them in order.
"""

from __future__ import annotations

import json
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm.elias_fano import SAMPLE, EliasFano
from harvestry.llm.files import Writer, mapped, unique
from harvestry.llm.tokens import encoder
from harvestry.llm.workers import map_batches
from harvestry.scratch import materialise

MAGIC = b"HVTOKEF1"
MANIFEST = "shard int, path string, docs long, ids long"
#: A file takes texts of about FILE_BYTES and about FILE_DOCS documents at most, so that a task and what it keeps of
#: boundaries stay bounded at any size. Smaller corpora have as many files as the root of their number of UNIT_BYTES.
FILE_BYTES, FILE_DOCS, UNIT_BYTES = 256 << 20, 1 << 20, 1 << 20
#: Ids are read back in slices of about SLICE, boundaries in blocks of BLOCK.
SLICE, BLOCK = 1 << 20, 16 * SAMPLE


class Shard:
    """A file, memory-mapped: ids of a document by its place, or by an id's offset."""

    def __init__(self, uri: str):
        data = mapped(uri)
        if bytes(data[-8:]) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        size = int(data[-12:-8].view("<u4")[0])
        self.about = about = json.loads(bytes(data[-12 - size : -12]))
        part = lambda name: data[about[name][0] : about[name][0] + about[name][1]]
        self.ids = part("ids").view(f"<u{about['width']}")
        self.doc_ids = part("doc_ids").view("<i8")
        self.nulls = part("nulls")
        self.bounds = EliasFano.of(about["docs"] + 1, about["low_bits"], [part("low"), part("high"), part("samples")])

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document, found by two selects."""
        return self.ids[self.bounds.get(i) : self.bounds.get(i + 1)]

    def null(self, i: int, j: int) -> np.ndarray:
        """Which of the documents from i to before j have a null id."""
        return np.unpackbits(self.nulls[i // 8 : (j + 7) // 8], bitorder="little")[i % 8 :][: j - i].astype(bool)

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        """(first document, boundaries) of runs of documents of about SLICE ids, each but a single longer one."""
        for at in range(0, self.about["docs"], BLOCK):
            bounds, i = self.bounds.run(at, min(at + BLOCK, self.about["docs"]) + 1), 0
            while i < len(bounds) - 1:
                j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + SLICE, "right")) - 1)
                yield at + i, bounds[i : j + 1]
                i = j


def write_shard(uri: str, docs: Iterator[tuple[int | None, np.ndarray]], width: int) -> tuple[int, int]:
    """Write documents (id, token ids) as they come; return their and the ids' count."""
    out = Writer(uri)
    doc_ids, nulls, ends = array("q"), bytearray(), array("q", [0])
    for doc_id, ids in docs:
        out.write(ids.astype(f"<u{width}", copy=False))
        doc_ids.append(doc_id or 0)
        nulls.append(doc_id is None)
        ends.append(ends[-1] + len(ids))
    coded = EliasFano.build(np.frombuffer(ends, np.int64))
    about = {"width": width, "docs": len(doc_ids), "low_bits": coded.low_bits, "ids": (0, out.size)}
    for name, part in zip(
        ("doc_ids", "nulls", "low", "high", "samples"),
        [np.array(doc_ids, "<i8"), np.packbits(np.frombuffer(nulls, bool), bitorder="little"), *coded.parts()],
        strict=True,
    ):
        out.write(b"\0" * (-out.size % 8))  # so that each part can be viewed in place
        about[name] = (out.write(part.tobytes()), part.nbytes)
    foot = json.dumps(about).encode()
    out.write(foot + np.uint32(len(foot)).tobytes() + MAGIC)
    out.close()
    return len(doc_ids), ends[-1]


def file_count(docs: DataFrame, text: str = "text", file_bytes: int = FILE_BYTES, file_docs: int = FILE_DOCS, unit_bytes: int = UNIT_BYTES) -> int:
    """How many files the texts' measured bytes and rows ask for."""
    size, rows = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count(F.lit(1))).first()
    return max(1, math.isqrt(size // unit_bytes), -(-size // file_bytes), -(-rows // file_docs))


def write_corpus(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> list[tuple]:
    """Encode every whole text (null: empty), append end_id, and write files in ascending id order.

    Returns the manifest: (shard, path, docs, ids) in order, one entry a file; file_count() says
    how many, so a file and the task that writes it are bounded whatever the input. Null document
    ids come first. Equal ids lie next to each other in any order, also when a third of all rows
    has one id: the row number takes part in the ranges. An empty table makes no file. A task that
    is run again writes a new file; the manifest has only those of the attempts that Spark took.
    Extra columns are not read.
    """
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("body")).withColumn("rid", F.monotonically_increasing_id())
    ranged = base.repartitionByRange(file_count(base, "body"), "id", "rid").sortWithinPartitions("id", "rid")

    def write(batches):
        from pyspark import TaskContext

        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()

        def rows():
            for batch in batches:
                ids = batch.column(0).to_pylist()
                yield from ((i, enc.wide(t.as_py(), end_id)) for i, t in zip(ids, batch.column(1), strict=True))

        uri, stream = unique(folder, f"tokens-{shard:06d}"), rows()
        first = next(stream, None)
        if first is not None:
            docs, ids = write_shard(uri, (x for s in ((first,), stream) for x in s), 4 if end_id >> 8 * enc.width else enc.width)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [uri], "docs": [docs], "ids": [ids]})

    # a row a file: 400,000 for 100 TB of texts
    made = materialise(map_batches(ranged, write, MANIFEST), "manifest")
    return sorted(tuple(r) for r in made.collect())


def read_corpus(spark: SparkSession, manifest: list[tuple]) -> DataFrame:
    """(doc_id long, start long, ids binary): the documents of the files, read by their boundaries.

    start counts the ids of all documents before in the corpus; ids are little-endian uint32.
    """
    schema = "doc_id long, start long, ids binary"
    if not manifest:
        return spark.createDataFrame([], schema)
    start, rows = 0, []
    for shard, path, _, ids in manifest:
        rows.append((shard, path, start))
        start += ids
    places = spark.createDataFrame(rows, "shard int, path string, start long").repartitionByRange(len(rows), "shard")

    def read(batches):
        for batch in batches:
            for place in batch.to_pylist():
                shard = Shard(place["path"])
                for i, bounds in shard.blocks():
                    n = len(bounds) - 1
                    wide = shard.ids[bounds[0] : bounds[-1]].astype("<u4")
                    ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(((bounds - bounds[0]) * 4).astype(np.int32)), pa.py_buffer(wide)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.doc_ids[i : i + n], mask=shard.null(i, i + n)), pa.array(bounds[:-1] + place["start"]), ids], ["doc_id", "start", "ids"]
                    )

    return map_batches(places, read, schema)
