"""Many small documents in few files: container files with an index of byte ranges.

Tasks append documents to a container of their own and begin another one at CONTAINER_BYTES, so the number of files grows
with the bytes, not with the documents. A container has a random name; the index, a Parquet table sorted by name, says
where each document lies, and only what it names counts: containers of tasks that were lost are never read. One document
is found by the index's statistics and read by its range alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafworks.sources.store import opened, written

CONTAINER_BYTES, READ_ROWS = 64 << 20, 256
INDEX = "name string, container string, start long, size long"


def write_packed(df: DataFrame, path: str, container_bytes: int = CONTAINER_BYTES) -> None:
    """Writes (name string, content binary) at path; null contents are empty. What was there before goes with the old index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(path)
        fs.create_dir(f"{root}/data", recursive=True)
        name, out, at = "", None, 0
        try:
            for b in batches:
                rows = []
                for key, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    if out is None or at >= container_bytes:
                        if out:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.bin", 0
                        out = fs.open_output_stream(f"{root}/data/{name}", compression=None)
                    out.write(content or b"")
                    rows.append((key, name, at, len(content or b"")))
                    at += len(content or b"")
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["name", "container", "start", "size"])
        finally:
            if out:
                out.close()

    index = written(df.select("name", "content").mapInArrow(run, INDEX))  # once: sorting by ranges looks at its rows twice
    index.repartitionByRange("name").sortWithinPartitions("name").write.mode("overwrite").parquet(f"{path}/index")


def read_packed(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """(name, content) of all documents at path, or of those that are named."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    if names:
        index = index.where(F.col("name").isin(*names))
    # A container's documents are read by one task in their order, READ_ROWS at a time.
    dealt = index.repartition("container").sortWithinPartitions("container", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(path)
        last, file = None, None
        try:
            for b in batches:
                for at in range(0, len(b), READ_ROWS):
                    part, found = b.slice(at, READ_ROWS), []
                    for container, start, size in zip(*(part.column(c).to_pylist() for c in ("container", "start", "size")), strict=True):
                        if container != last:
                            if file:
                                file.close()
                            last, file = container, fs.open_input_file(f"{root}/data/{container}")
                        found.append(file.read_at(size, start))
                    yield pa.RecordBatch.from_arrays([part.column("name"), pa.array(found, pa.binary())], names=["name", "content"])
        finally:
            if file:
                file.close()

    return dealt.mapInArrow(run, "name string, content binary")
