"""A table with upserts by key as a data sink: df.write.format("upserts") and, for streams, df.writeStream.format("upserts").

Below the table's folder lie data/<random name>.parquet and log/<batch>.json. Tasks write data files and hand their names
to the driver; a batch counts once its log file is there, which is moved to its place in one step. So a write that is
killed leaves files that nobody names, one that is repeated under the same number changes nothing, and a task that is run
twice is named once. Rows stay where they are: current() takes of each key the row of the last batch that brought one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from leafworks.sources.store import listing, opened, written_once

#: Rows after which a task begins another file.
FILE_ROWS = 5_000_000


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    rows: int


class Table:
    """The folder of a table, as its writers see it."""

    def __init__(self, path: str, schema: StructType) -> None:
        self.path, self.schema = path, schema

    def put(self, batches: Iterator[pa.RecordBatch]) -> Written:
        """Writes a task's rows to new files; a task without rows writes none."""
        fs, root = opened(self.path)
        fs.create_dir(f"{root}/data", recursive=True)
        shape, writer, done = to_arrow_schema(self.schema), None, Written([], 0)
        size = 0
        try:
            for b in batches:
                if not len(b):
                    continue
                if writer is None or size >= FILE_ROWS:
                    if writer:
                        writer.close()
                    done.files.append(f"{uuid.uuid4().hex}.parquet")
                    writer, size = pq.ParquetWriter(f"{root}/data/{done.files[-1]}", shape, filesystem=fs), 0
                writer.write_table(pa.Table.from_batches([b]).cast(shape))
                size, done.rows = size + len(b), done.rows + len(b)
        finally:
            if writer:
                writer.close()
        return done

    def enter(self, messages: list[Written | None], batch: int, replaces: bool = False) -> bool:
        """Enters a batch in the log, unless it is there: then its new files go and the answer is false."""
        fs, root = opened(self.path)
        fs.create_dir(f"{root}/log", recursive=True)
        entry = f"{root}/log/{batch:012d}.json"
        if fs.get_file_info(entry).is_file:
            self.drop(messages)
            return False
        files = [f for m in messages if m for f in m.files]
        written_once(fs, entry, json.dumps({"batch": batch, "files": files, "rows": sum(m.rows for m in messages if m), "replaces": replaces}).encode())
        return True

    def drop(self, messages: list[Written | None]) -> None:
        fs, root = opened(self.path)
        for m in messages:
            for f in m.files if m else ():
                fs.delete_file(f"{root}/data/{f}")


class UpsertWriter(DataSourceArrowWriter):
    """The two phases of a batch of rows: tasks write, the driver enters the batch; abort() deletes what tasks wrote."""

    def __init__(self, table: Table, batch: int) -> None:
        self.table, self.batch = table, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.table.put(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.table.enter(messages, self.batch)

    def abort(self, messages: list[Written | None]) -> None:
        self.table.drop(messages)


class UpsertStreamWriter(DataSourceStreamArrowWriter):
    """The same for each micro-batch, under the stream's own number for it."""

    def __init__(self, table: Table) -> None:
        self.table = table

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.table.put(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        self.table.enter(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        self.table.drop(messages)


class UpsertSink(DataSource):
    """Options: path; batch, the number of a batch that isn't a stream's."""

    @classmethod
    def name(cls) -> str:
        return "upserts"

    def writer(self, schema: StructType, overwrite: bool) -> UpsertWriter:
        if overwrite:
            raise ValueError("upserts are appended")
        return UpsertWriter(Table(self.options["path"], schema), int(self.options["batch"]))

    def streamWriter(self, schema: StructType, overwrite: bool) -> UpsertStreamWriter:  # noqa: N802
        return UpsertStreamWriter(Table(self.options["path"], schema))


def upsert(df: DataFrame, path: str, batch: int) -> None:
    """Writes the rows as one batch of the table at path. A number that was written before changes nothing."""
    df.sparkSession.dataSource.register(UpsertSink)
    df.write.format("upserts").mode("append").option("batch", batch).save(path)


def entries(path: str) -> list[dict]:
    """The batches that count, in their order: those from the last one on that replaces the others before it."""
    fs, root = opened(path)
    found = []
    for at, _ in listing(f"{path}/log", ".json"):
        with fs.open_input_stream(at) as f:
            found.append(json.loads(f.read()))
    last = max((k for k, e in enumerate(found) if e["replaces"]), default=0)
    return found[last:]


def current(spark: SparkSession, path: str, schema: str, key: str, order: str | None = None) -> DataFrame:
    """Of each key the row of the last batch that brought one; of a batch's rows with one key that with the greatest
    order column, then with the greatest values. Partial maxima in each task, no sort by key."""
    counted = entries(path)
    names = [(f, e["batch"]) for e in counted for f in e["files"]]
    if not names:
        return spark.createDataFrame([], schema)
    batches = spark.createDataFrame(names, "_file string, _batch long")
    rows = spark.read.schema(schema).parquet(*(f"{path}/data/{f}" for f, _ in names)).withColumn("_file", F.regexp_extract("_metadata.file_path", "([^/]+)$", 1))
    values = [c for c in rows.columns if c not in (key, "_file")]
    last = F.max_by(F.struct(*values), F.struct("_batch", *([order] if order else []), *values)).alias("_x")
    return rows.join(F.broadcast(batches), "_file").groupBy(key).agg(last).select(*(F.col(c) if c == key else F.col(f"_x.{c}") for c in rows.columns if c != "_file"))


def compact(spark: SparkSession, path: str, schema: str, key: str, order: str | None = None) -> None:
    """Writes current() as a batch that replaces all before it. Files that no batch names can be deleted once no reader uses them."""
    found = current(spark, path, schema, key, order)
    number = max((e["batch"] for e in entries(path)), default=-1)
    table = Table(path, found.schema)
    with_names = found.mapInArrow(lambda batches: (pa.RecordBatch.from_pylist([{"files": w.files, "rows": w.rows}], SUMMARY) for w in [table.put(batches)]), "files array<string>, rows long")
    table.enter([Written(r.files, r.rows) for r in with_names.collect()], number + 1, replaces=True)


SUMMARY = pa.schema([("files", pa.list_(pa.string())), ("rows", pa.int64())])
