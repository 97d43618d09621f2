"""What the operators of this subpackage share: text defaults, scratch tables, Arrow batches."""

from __future__ import annotations

import itertools
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts, `[\x20\x09-\x0D]`, as a character class.
BLANK = r"[\x20\x09-\x0D]"
NON_BLANK = r"[^\x20\x09-\x0D]"
BLANK_CHARS = " \t\n\x0b\x0c\r"
#: Rows in an Arrow batch of the Python operators: texts of a few KB then make batches of a few MB.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def without_blanks(text: Column) -> Column:
    """Deletes the six blanks; byte-wise replacement is cheaper than one regular expression."""
    for c in BLANK_CHARS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def free(name: str, df: DataFrame) -> str:
    """name, or one like it that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows, and where Spark can the bytes, that go to a Python worker at once, whatever the length of the
    texts. The setting is read when a plan is made, so it stays for the session: frames are run after this returns."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def scratch(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder. Only a local session without one gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="leafworks-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/leafworks-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, survives lost executors. discard() deletes it."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[next(_numbers)] = (weakref.ref(out), path)
    return out


#: The folders of written frames that are still there, in the order of writing.
_written: dict[int, tuple[weakref.ref, str]] = {}
_numbers = itertools.count()


@contextmanager
def scratch_of(keep: Callable[[], DataFrame | None] = lambda: None) -> Iterator[None]:
    """Deletes what is written within, but for the frame that keep() gives at the end: what a stage leaves behind once
    its result is written."""
    before = set(_written)
    yield
    kept = keep()
    for number in set(_written) - before:
        frame = _written[number][0]()
        if frame is None:
            deleted(_written.pop(number)[1], SparkSession.getActiveSession())
        elif frame is not kept:
            discard(frame)


def deleted(path: str, spark: SparkSession) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*frames: DataFrame) -> None:
    """Deletes the folders of written frames that nothing will read again, as a later one was written from them."""
    for df in frames:
        for number in [k for k, (ref, _) in _written.items() if ref() is df]:
            deleted(_written.pop(number)[1], df.sparkSession)
