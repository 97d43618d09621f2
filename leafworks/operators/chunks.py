"""Chunks with overlap: an ordered fold over the blocks of a document, in Arrow batches.

The fold's state must hold the chunks so far; inside the JVM an aggregate copies it at each step, which is quadratic in a
document's chunks (225 s for one of 100,000 blocks; 2 s so). Documents are dealt over tasks; one document is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafworks.functions import text as T
from leafworks.sources.store import bounded_batches

CHUNKS = "array<struct<text:string,ids:array<int>,pages:array<int>>>"


def fold(blocks: list[dict], size: int, overlap: int) -> list[dict]:
    """The chunks of a document's blocks (seq, text, page_num) in order; texts are stripped and not empty."""
    done, now, ids, pages = [], "", [], []

    def made() -> dict:
        known = sorted({p for p in pages if p is not None})
        return {"text": now.strip(), "ids": ids, "pages": known + [None] * (None in pages)}

    for b in blocks:
        text = b["text"]
        if now and len(now) + len(text) > size:
            done.append(made())
            tail = now[len(now) - overlap :] if len(now) > overlap else ""
            now, ids, pages = f"{tail} {text}", [b["seq"]], [b["page_num"]]
        else:
            now = f"{now} {text}".strip()
            ids.append(b["seq"])
            pages.append(b["page_num"])
    return [*done, made()] if blocks else done


def chunks(df: DataFrame, size: int = 1000, overlap: int = 200) -> DataFrame:
    """(file_id, doc_id, chunk_no, chunk_id, text, character_count, block_ids, pages) from blocks (file_id, page_num,
    doc_id, seq, text); pages are the chunk's distinct page numbers in rising order.

    Blocks are appended until the next one would pass `size` code points (the joining space isn't counted; a longer
    block stays whole). The next chunk starts with the last `overlap` code points of the one before, if that was
    longer. Blank blocks don't count; a document without others has no chunk.
    """
    text = T.strip(F.col("text"))
    block = F.struct("seq", "text", "page_num") if "page_num" in df.columns else F.struct("seq", "text", F.lit(None).cast("int").alias("page_num"))
    rows = df.withColumn("text", text).where("text != ''").groupBy("file_id", "doc_id").agg(F.array_sort(F.collect_list(block)).alias("blocks"))

    bounded_batches(df.sparkSession)

    @F.arrow_udf(CHUNKS)
    def folded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("ids", pa.list_(pa.int32())), ("pages", pa.list_(pa.int32()))]))
        for part in parts:
            yield pa.array([fold(blocks, size, overlap) for blocks in part.to_pylist()], kind)

    found = rows.select("file_id", "doc_id", F.posexplode(folded("blocks")).alias("pos", "chunk"))
    number = F.col("pos") + 1
    return found.select(
        "file_id", "doc_id", number.alias("chunk_no"), F.format_string("chk_%04d", number).alias("chunk_id"), "chunk.text",
        F.length("chunk.text").alias("character_count"), F.col("chunk.ids").alias("block_ids"), F.col("chunk.pages").alias("pages"),
    )


def documents(found: DataFrame) -> DataFrame:
    """(file_id, document): the chunk document of each file's document as JSON: its name, the number of chunks, and the
    chunks with their metadata, in order."""
    name = F.concat_ws("/", "file_id", F.col("doc_id").cast("string"))
    meta = F.struct(name.alias("file_name"), F.col("pages").alias("page_numbers"), F.transform("block_ids", lambda x: F.format_string("blk_%04d", x + 1)).alias("source_block_ids"))
    chunk = F.struct("chunk_no", F.struct("chunk_id", "text", "character_count", meta.alias("metadata")).alias("c"))
    ordered = F.transform(F.array_sort(F.collect_list(chunk), lambda a, b: a["chunk_no"] - b["chunk_no"]), lambda x: x["c"])
    whole = found.groupBy("file_id", "doc_id").agg(F.count("*").alias("chunk_count"), ordered.alias("chunks"))
    return whole.select(name.alias("file_id"), F.to_json(F.struct(name.alias("file_name"), "chunk_count", "chunks")).alias("document"))


def stats(found: DataFrame) -> DataFrame:
    return found.groupBy("file_id").agg(
        F.count("*").alias("chunks"), F.min("character_count").alias("shortest"), F.max("character_count").alias("longest"),
        F.round(F.avg("character_count").cast("decimal(20,6)"), 2).cast("double").alias("mean"),
    )


def totals(found: DataFrame) -> DataFrame:
    """Chunks per file and, with file_id TOTAL, overall."""
    rolled = found.rollup("file_id").agg(F.count("*").alias("chunks"), F.grouping("file_id").alias("g"))
    return rolled.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("file_id")).alias("file_id"), "chunks")
