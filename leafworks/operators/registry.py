"""Registry and vector-store tables: latest state, upserts, matches of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafworks.sources.store import written


def latest(changes: DataFrame, key: str, at: str, values: list[str]) -> DataFrame:
    """One row per key: of each value the latest that isn't null. A partial maximum in each task, no sort by key."""
    return changes.groupBy(key).agg(F.max(at).alias(at), *(F.max(F.when(F.col(v).isNotNull(), F.struct(at, v)))[v].alias(v) for v in values))


def last_by_key(df: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Of the rows of each key the one with the greatest order column, then with the greatest values, column by column."""
    values = [c for c in df.columns if c != key]
    if not values:
        return df.distinct()
    last = F.max_by(F.struct(*values), F.struct(*([order] if order else []), *values)).alias("_x")
    return df.groupBy(key).agg(last).select(*(F.col(c) if c == key else F.col(f"_x.{c}") for c in df.columns))


def upserted(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """old with the rows of new put in by key; of rows of new that repeat a key the last one, as last_by_key() has it."""
    return old.join(new.select(key), key, "left_anti").unionByName(last_by_key(new, key, order))


def changed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the values of new that aren't null put in by key; keys that old doesn't have are left out."""
    values = [c for c in old.columns if c != key]
    found = old.join(new.select(F.col(key), *(F.col(c).alias(f"_{c}") for c in values if c in new.columns)), key, "left")
    return found.select(*(F.coalesce(f"_{c}", c).alias(c) if c in values and c in new.columns else F.col(c) for c in old.columns))


def matched(files: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """(key, found): files with an output, and those without."""
    return files.join(outputs.select(key).distinct().withColumn("found", F.lit(True)), key, "left").select(key, F.coalesce("found", F.lit(False)).alias("found"))


def upload_path(folder: str, classification: Column, file_id: Column) -> Column:
    """Where an accepted upload lies: a folder for each class, in lower case."""
    return F.concat_ws("/", F.lit(folder), F.lower(classification), F.concat(file_id, F.lit(".pdf")))


def intake(found: DataFrame, allowed: list[str]) -> DataFrame:
    """Adds error: why an upload (file_name, classification) isn't taken in, null if it is."""
    wrong_class = ~F.coalesce(F.col("classification").isin(allowed), F.lit(False))
    wrong_name = ~F.coalesce(F.lower("file_name").endswith(".pdf"), F.lit(False))
    return found.withColumn("error", F.when(wrong_class, "classification").when(wrong_name, "extension"))


def engine(scanned: Column, forced: Column) -> Column:
    """The engine for a file: the forced one, or by whether it is scanned; an unknown forced one means native text."""
    name = F.lower(forced)
    return F.when(name == "vlm", "vlm").when(name.isNotNull(), "layout").when(F.coalesce(scanned, F.lit(True)), "vlm").otherwise("layout")


def collection(classification: Column, names: dict[str, str]) -> Column:
    """The collection of a class, null for one that has none."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in names.items():
        out = out.when(classification == k, v)
    return out


def response(found: DataFrame) -> DataFrame:
    """Registry rows as they are shown: the id under its own name, times in ISO form."""
    times = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) for c in ("created_at", "updated_at") if c in found.columns]
    rest = [c for c in found.columns if c not in ("id", "created_at", "updated_at")]
    return found.select(F.col("id").alias("document_id"), *rest, *times)


def ingest_stats(files: DataFrame, chunks: DataFrame, dry_run: bool = False) -> DataFrame:
    """(file_id, chunks, vectors, status, error) of a batch: files without chunks are errors; a dry run counts alone."""
    counts = chunks.groupBy("file_id").agg(F.count("*").alias("chunks"))
    n = F.coalesce("chunks", F.lit(0).cast("long"))
    out = files.select("file_id").join(counts, "file_id", "left").withColumn("chunks", n)
    none = F.col("chunks") == 0
    status = F.when(none, "error").otherwise("dry_run" if dry_run else "ok")
    vectors = F.when(none | F.lit(dry_run), 0).otherwise(F.col("chunks")).cast("long")
    return out.select("file_id", "chunks", vectors.alias("vectors"), status.alias("status"), F.when(none, "No chunks in preprocessed JSON").alias("error"))


def numbered(df: DataFrame, *order: str, into: str = "number") -> DataFrame:
    """Adds the place of each row among all, from 1, by the order columns, which no two rows should share.

    Rows are dealt by ranges of the order and written once with their range's number; the counts of the ranges, as many
    as there are shuffle partitions, give each its offset. A task numbers its ranges, none holds all rows.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    offsets, at = [], 0
    for r in sorted(dealt.groupBy("_range").count().collect(), key=lambda r: r["_range"]):
        offsets.append((r["_range"], at))
        at += r["count"]
    starts = df.sparkSession.createDataFrame(offsets, "_range int, _start long")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.col("_start")
    return dealt.join(F.broadcast(starts), "_range").withColumn(into, place).select(*df.columns, into)


def progress(found: DataFrame, order: str = "path") -> DataFrame:
    """Adds label: [place/number of rows], by order. The rows are a batch's files."""
    total = F.lit(found.count())
    out = numbered(found, order, into="_place")
    return out.withColumn("label", F.format_string("[%d/%d]", "_place", total)).drop("_place")


def collections(spark: SparkSession) -> set[str]:
    """The names of the tables that stand for vector collections."""
    return {t.name for t in spark.catalog.listTables()}


def ensure_collection(spark: SparkSession, name: str, columns: str, reset: bool = False) -> None:
    """Creates a collection's table if there is none; with reset an existing one is dropped first."""
    if reset:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def drop_collections(spark: SparkSession, names: set[str] | None = None) -> None:
    """Drops the named collections, or all."""
    for name in collections(spark) if names is None else names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def stamped(df: DataFrame, into: str = "extracted_at") -> DataFrame:
    """Adds the time of the run in ISO form, in UTC, the same in all rows."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return df.withColumn(into, F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
