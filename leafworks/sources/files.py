"""Files: discovery and validation of binary files, JSON documents in and out."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafworks.functions import text as T
from leafworks.sources.packed import read_packed, write_packed
from leafworks.sources.store import entries, opened

DOCUMENT = """document_metadata struct<file_name:string,file_path:string,file_size_mb:double,page_count:int,extracted_at:string,extractor_engine:string>,
extraction_summary struct<total_blocks:int,content_blocks:int,boilerplate_blocks:int,corrected_blocks:int,table_count:int,image_count:int,total_ner_entities:int>,
text_blocks array<struct<block_id:string,page_num:int,type:string,text:string,bbox:array<double>,
is_boilerplate:boolean,boilerplate_type:string,was_corrected:boolean,raw_text:string,entities:array<struct<text:string,label:string,start:int,end:int>>>>,
tables array<struct<table_id:string,page_num:int,caption:string,headers:array<string>,rows:array<array<string>>,row_count:int,column_count:int>>"""


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """path, modificationTime, length, content of all files below the folder that have bytes. Contents aren't sorted: the
    files' order is that of their path, which registry.progress() numbers."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)


#: Folders that the driver lists at most, level by level, before tasks list what lies below.
LISTED_FOLDERS = 1000


def listed(spark: SparkSession, folder: str, least: int = 64) -> DataFrame:
    """(path, length) of all files below the folder, those without bytes too; an empty frame if there is none, or no folder.

    The driver goes down level by level until there are `least` folders or none below; it has listed LISTED_FOLDERS at
    most by then. Tasks list those folders with all that lies below them, so what the driver holds is bounded by one
    level's entries. The rest of the listing goes from folder to rows in the tasks.
    """
    todo, done = [(folder, True)], []
    while todo and len(todo) < least and len(done) < LISTED_FOLDERS:
        at, _ = todo.pop(0)
        done.append((at, False))
        todo += [(f, True) for f, is_folder, _ in entries(at) if is_folder]
    parts = spark.createDataFrame(done + todo, "folder string, deep boolean").repartition(max(1, len(done + todo)), "folder")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, deep in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows = [(path, size) for path, is_folder, size in entries(at, deep) if not is_folder]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["path", "length"])

    return parts.mapInArrow(run, "path string, length long")


def with_heads(found: DataFrame, chars: int = 5) -> DataFrame:
    """Adds head: each file's first bytes (null where it can't be read), the only ones that are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads = []
            for path in b.column(0).to_pylist():
                try:
                    fs, at = opened(path)
                    with fs.open_input_stream(at, compression=None) as f:
                        heads.append(f.read(chars))
                except OSError:
                    heads.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(heads, pa.binary())], names=["path", "length", "head"])

    return found.select("path", "length").mapInArrow(run, "path string, length long, head binary")


def validated(found: DataFrame, max_mb: int = 100) -> DataFrame:
    """(path, size_mb, errors): what is wrong with each file; an empty list for a valid one. found: path, length, and
    head (the first bytes) and, where known, page_count. A file without bytes has no other error, nor has one whose
    head can't be read any after that."""
    size_mb = F.round(F.col("length") / 1048576, 2)
    pages = F.col("page_count") if "page_count" in found.columns else F.lit(None).cast("int")
    errors = F.filter(F.array(
        F.when(~F.lower("path").endswith(".pdf"), "extension"), F.when(size_mb > max_mb, "size"),
        F.when(F.col("head").isNull(), "unreadable").when(F.substring("head", 1, 5) != F.lit(b"%PDF-"), "header"),
        F.when(F.col("head").isNotNull() & (pages < 1), "no_pages"),
    ), lambda e: e.isNotNull())
    return found.select("path", size_mb.alias("size_mb"), F.when(F.col("length") == 0, F.array(F.lit("empty"))).otherwise(errors).alias("errors"))


def scanned(pages: DataFrame, sample: int = 8, below: float = 150.0) -> DataFrame:
    """(file_id, scanned): whether evenly spread pages have few characters on average. pages: file_id, page_num, text;
    a file whose pages can't be read (null text) counts as scanned, one without pages is left out."""
    n = pages.groupBy("file_id").agg(F.max("page_num").alias("n"))
    step = F.greatest(F.floor(F.col("n") / sample), F.lit(1))
    turn = (F.col("page_num") - 1 - F.floor(F.col("step") / 2)) % F.col("step") == 0
    first = F.floor((F.col("page_num") - 1) / F.col("step")) < sample
    picked = pages.join(n, "file_id").withColumn("step", step).where(turn & first)
    return picked.groupBy("file_id").agg((F.coalesce(F.avg(F.length(T.strip(F.col("text")))), F.lit(0.0)) < below).alias("scanned"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{DOCUMENT}, _corrupt_record string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def write_documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def assembled(df: DataFrame, files: DataFrame, tables: DataFrame | None = None, images: DataFrame | None = None) -> DataFrame:
    """(file_id, document): each file's nested document with its metadata, summary, blocks, tables and images in order.

    df: file_id, page_num, doc_id, seq, type, text, is_boilerplate, was_corrected, and entities where they were looked for.
    files: file_id, file_name, extracted_at. tables: file_id, page_num, table_id, caption, headers, rows, row_count,
    column_count. images: file_id, page_num, filename. The summary counts all of these; a file without blocks is left out.
    """
    bad = F.coalesce("is_boilerplate", F.lit(False))
    has = "entities" in df.columns
    block = F.struct("page_num", "doc_id", "seq", "type", "text", "is_boilerplate", "was_corrected", *(["entities"] if has else []))
    entities = F.sum(F.coalesce(F.size("entities"), F.lit(0))) if has else F.lit(0)
    parts = df.groupBy("file_id").agg(
        F.struct(
            F.count("*").alias("total_blocks"), F.count_if(~bad).alias("content_blocks"), F.count_if(bad).alias("boilerplate_blocks"),
            F.count_if(F.coalesce("was_corrected", F.lit(False))).alias("corrected_blocks"), entities.cast("long").alias("total_ner_entities"),
        ).alias("counts"),
        F.array_sort(F.collect_list(block)).alias("text_blocks"),
    )
    meta = files.select("file_id", F.struct("file_name", "extracted_at").alias("document_metadata"))
    table = F.struct("page_num", "table_id", "caption", "headers", "rows", "row_count", "column_count")
    for name, frame, shape in (("tables", tables, table), ("page_images", images, F.struct("page_num", "filename"))):
        if frame is None:
            parts = parts.withColumn(name, F.array().cast("array<struct<page_num:int>>"))
        else:
            listed = frame.groupBy("file_id").agg(F.array_sort(F.collect_list(shape)).alias(f"_{name}"))
            parts = parts.join(listed, "file_id", "left").withColumn(name, F.coalesce(f"_{name}", F.array())).drop(f"_{name}")
    totals = {"table_count": F.size("tables"), "image_count": F.size("page_images")}
    summary = F.struct("counts.*", *(n.alias(c) for c, n in totals.items())).alias("extraction_summary")
    whole = parts.join(meta, "file_id").select("file_id", "document_metadata", summary, "text_blocks", "tables", "page_images")
    return whole.select("file_id", F.to_json(F.struct("document_metadata", "extraction_summary", "text_blocks", "tables", "page_images")).alias("document"))


def write_chunks(found: DataFrame, path: str) -> None:
    """Chunk documents (file_id, document), packed: see packed.write_packed()."""
    write_packed(found.select(F.col("file_id").alias("name"), F.encode("document", "utf-8").alias("content")), path)


def read_chunks(spark: SparkSession, path: str, *file_ids: str) -> DataFrame:
    """(file_id, chunk_id, text, character_count, page_numbers, block_ids) of the chunk documents at path, all or those
    that are named."""
    raw = read_packed(spark, path, *file_ids).select(F.col("name").alias("file_id"), F.decode("content", "utf-8").alias("document"))
    return exploded_chunks(raw)


CHUNK_DOCUMENT = """file_name string, chunk_count int, chunks array<struct<chunk_id:string,text:string,character_count:int,
metadata:struct<file_name:string,page_numbers:array<int>,source_block_ids:array<string>>>>"""


def exploded_chunks(found: DataFrame) -> DataFrame:
    """A row per chunk of chunk documents (file_id, document)."""
    parsed = found.select("file_id", F.explode(F.from_json("document", CHUNK_DOCUMENT)["chunks"]).alias("c"))
    return parsed.select(
        "file_id", "c.chunk_id", "c.text", "c.character_count", F.col("c.metadata.page_numbers").alias("page_numbers"),
        F.col("c.metadata.source_block_ids").alias("block_ids"),
    )


#: The box of a block whose answer gives none, and the source of a model's blocks.
WHOLE_PAGE, MODEL_SOURCE = (0.0, 0.0, 612.0, 792.0), "vlm"


def normalized_blocks(df: DataFrame, raw: str, page: str = "doc_id", source: str = MODEL_SOURCE) -> DataFrame:
    """(doc_id, block_no, block_id, page_num, type, text, bbox, is_boilerplate, boilerplate_type, was_corrected, entities,
    source) from a model's answer about a page: a JSON array of blocks, or one block, perhaps between code fences.

    Elements that are no objects, or have no text, are left out; numbers are those of the answer. A block without a box,
    or with null, has that of a whole page; none is corrected or has entities yet. page: the column of the page's number.
    """
    listed = lambda c: F.when(c.startswith("["), c).otherwise(F.concat(F.lit("["), c, F.lit("]")))
    text = T.named(T.without_fences(F.col(raw)), listed)
    block = lambda x: F.from_json(x, "type string, text string, bbox array<double>, is_boilerplate boolean")
    found = F.transform(F.from_json(text, "array<string>"), block)  # before the rows: a filter of rows would parse them again
    rows = df.select("doc_id", F.col(page).cast("int").alias("page_num"), F.posexplode(found).alias("block_no", "b"))
    rows = rows.where(T.strip(F.col("b.text")) != "")
    bad = F.coalesce("b.is_boilerplate", F.lit(False))
    return rows.select(
        "doc_id", "block_no", F.format_string("blk_p%04d_%03d", F.col("page_num"), F.col("block_no") + 1).alias("block_id"), "page_num",
        F.coalesce("b.type", F.lit("paragraph")).alias("type"), T.strip(F.col("b.text")).alias("text"),
        F.coalesce("b.bbox", F.array(*(F.lit(x) for x in WHOLE_PAGE))).alias("bbox"),
        bad.alias("is_boilerplate"), F.when(bad, F.col("b.type")).alias("boilerplate_type"), F.lit(False).alias("was_corrected"),
        F.array().cast("array<struct<text:string,label:string,start:int,end:int>>").alias("entities"), F.lit(source).alias("source"),
    )
