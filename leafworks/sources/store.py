"""Files in any store that has a URI, from Python tasks."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it. Names are taken as they are: nothing in them is escaped."""
    scheme, host, path = re.fullmatch(r"(?s)(?:([A-Za-z][\w+.-]*):(?://([^/]*))?(?=/))?(.*)", uri).groups()
    if scheme in (None, "file"):
        return pafs.LocalFileSystem(), path
    fs, root = pafs.FileSystem.from_uri(f"{scheme}://{host or ''}/")
    return fs, root.rstrip("/") + path


def listing(uri: str, suffix: str = "") -> list[tuple[str, int]]:
    """(path, size) of the file, or of the files below a folder, in the order of path; marks and hidden files are left out."""
    fs, path = opened(uri)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    found = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
    return sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._" and f.path.endswith(suffix))


def entries(uri: str, deep: bool = False) -> list[tuple[str, bool, int]]:
    """(URI, whether it is a folder, size) of what lies in a folder, or below it; nothing if there is no folder."""
    fs, path = opened(uri)
    if fs.get_file_info(path).type != pafs.FileType.Directory:
        return []
    found = fs.get_file_info(pafs.FileSelector(path, recursive=deep))
    stem = uri[: len(uri) - len(path)]
    return [(stem + f.path, f.type == pafs.FileType.Directory, f.size or 0) for f in found]


def written_once(fs: pafs.FileSystem, path: str, content: bytes) -> None:
    """Writes a file under another name and moves it to its place, so that none sees a part of it."""
    with fs.open_output_stream(f"{path}.part") as f:
        f.write(content)
    fs.move(f"{path}.part", path)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that spark.checkpoint.dir names; only a local session without one gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="leafworks-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/leafworks-{uuid.uuid4().hex}"


#: Rows and bytes of an Arrow batch: a worker then holds a few MB of texts and what it makes of them, whatever the input.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the rows and bytes that go to a Python worker at once. The settings are read when a plan is made, so they stay
    for the session; fewer rows that are set already stay as they are."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
