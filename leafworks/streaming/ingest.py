"""Streaming ingest (an extension): the batch transforms over a stream, upserted batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from leafworks.operators.registry import last_by_key


def upsert_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, key: str, checkpoint: str, order: str | None = None) -> StreamingQuery:
    """Each micro-batch is transformed and written to its own folder below path, one row a key; current() gives the rows
    that hold. So a batch costs what it brings, whatever is there already. Of a batch's rows with one key the last by order
    stays, as last_by_key() has it.

    A batch that is run again writes its own folder again: results don't double.
    """

    def put(batch: DataFrame, number: int) -> None:
        last_by_key(transform(batch), key, order).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """Of each key the row of the last batch that brought one. Partial maxima in each task, no sort by key."""
    rows = spark.read.schema(f"{schema}, batch long").parquet(path)
    values = [c for c in rows.columns if c not in (key, "batch")]
    last = F.max_by(F.struct(*values), "batch").alias("x")
    return rows.groupBy(key).agg(last).select(key, *(F.col(f"x.{c}") for c in values))


def compacted(spark: SparkSession, path: str, schema: str, key: str, into: str) -> None:
    """Writes current() as the first batch of a new folder, for a stream that has gone on for long."""
    current(spark, path, schema, key).write.mode("overwrite").parquet(f"{into}/batch=-1")
