"""The lifecycle of documents as a stateful stream: the latest value of each field a key, whatever the order of events.

State is one row a key: of each field the time of its last value that isn't null, and the value. An event changes a field
only if it isn't older than that, so any order gives the same state. Without a time column that is a running maximum, which
Spark's own aggregation keeps: no key costs a call of Python. With a time column a timer closes a key once the
watermark has passed its last event by `idle`: until then late events count; after it the key's row is final and its state
is gone, so the state holds open keys alone. Events older than the watermark are left out by Spark, as with all windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from leafworks.operators.registry import latest
from leafworks.sources.upserts import upsert

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Before all times.
NONE = -(1 << 63)


class Lifecycle(StatefulProcessor):
    """fields: name -> type; order: a column of whole numbers; time: a timestamp column."""

    def __init__(self, key: str, order: str, fields: dict[str, str], time: str, idle_ms: int) -> None:
        self.key, self.order, self.fields, self.time, self.idle_ms = key, order, fields, time, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("fields", f"at long, seen long, {', '.join(f'at_{f} long, {f} {kind}' for f, kind in self.fields.items())}")

    def row(self, key: tuple, held: list, final: bool) -> pd.DataFrame:
        values = {f: [held[2 * k + 1]] for k, f in enumerate(self.fields, 1)}
        return pd.DataFrame({self.key: [key[0]], self.order: [held[0]], **values, "final": [final]})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = list(self.state.get()) if self.state.exists() else [NONE, NONE] + [NONE, None] * len(self.fields)
        for part in rows:
            held[0] = max(held[0], int(part[self.order].max()))
            for k, f in enumerate(self.fields, 1):
                known = part[part[f].notna()]
                if len(known):
                    last = known[known[self.order] == known[self.order].max()]
                    new = int(last[self.order].iloc[0]), last[f].max()
                    if held[2 * k + 1] is None or new > (held[2 * k], held[2 * k + 1]):
                        held[2 * k], held[2 * k + 1] = new[0], new[1].item() if hasattr(new[1], "item") else new[1]
            held[1] = max(held[1], part[self.time].max().value // 1_000_000)
        self.state.update(tuple(held))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(held[1] + self.idle_ms)
        yield self.row(key, held, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = list(self.state.get())
        self.state.clear()
        yield self.row(key, held, True)

    def close(self) -> None:
        pass


def lifecycle(events: DataFrame, key: str, order: str, fields: dict[str, str], time: str | None = None, late: str = "1 hour", idle_ms: int = 3_600_000) -> DataFrame:
    """(key, order, fields, final) for each key that a micro-batch touches: the greatest order and of each field the value
    with the greatest order, then the greatest value, that isn't null. Final rows come once, from timers, if time is given.

    Rows without a key or an order are left out.
    """
    kinds = dict(events.dtypes)
    known = events.where(f"`{key}` IS NOT NULL AND `{order}` IS NOT NULL")
    if not time:
        cast = known.withColumns({f: F.col(f"`{f}`").cast(kind) for f, kind in fields.items()})
        return latest(cast, key, order, list(fields)).withColumn("final", F.lit(False))
    known = known.withWatermark(time, late)
    shape = f"`{key}` {kinds[key]}, `{order}` {kinds[order]}, {', '.join(f'`{f}` {kind}' for f, kind in fields.items())}, final boolean"
    processor = Lifecycle(key, order, fields, time, idle_ms)
    return known.groupBy(key).transformWithStateInPandas(processor, outputStructType=shape, outputMode="update", timeMode="EventTime")


def followed(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs a stream of lifecycle() over what there is, each micro-batch put into the table of upserts at path, once
    under its number, also if it is run again. Under the same checkpoint a later run goes on where this one ended, with the
    state that it left."""
    spark = changes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def put(batch: DataFrame, number: int) -> None:
        upsert(batch, path, number)

    return changes.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
