"""The registered queries of the library: each applies operators to whole tables; sql.py holds their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafworks.functions import patterns as P
from leafworks.functions import text as T
from leafworks.operators import audit, boilerplate, chunks, entities, registry, sequences, tables, vectors
from leafworks.operators import blocks as B
from leafworks.plans import planted as plants
from leafworks.plans.sql import ORACLE_SQL  # noqa: F401
from leafworks.settings import from_environment
from leafworks.sources import elements, files, html, store, upserts
from leafworks.streaming import lifecycle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SETTINGS = from_environment()


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.blocks(read(spark, sf_dir, "documents"))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).withColumn("type", B.block_type())


def planted(spark: SparkSession, sf_dir: str, whole_files: bool = False) -> DataFrame:
    """Typed and boxed blocks of the documents with planted lines; with whole_files a file's blocks lie in one partition."""
    docs = read(spark, sf_dir, "documents")
    df = B.with_box(B.blocks(plants.planted(B.by_file(docs) if whole_files else docs)))
    return df.withColumns({"type": plants.layout_type(B.block_type()), "y0": plants.layout_top(F.col("y0"))})


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted blocks after the passes of boilerplate and the rescues of headings and questions."""
    return boilerplate.rescued_questions(boilerplate.rescued_headings(boilerplate.processed(planted(spark, sf_dir, True))))


def lined_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.from_lines(lines(spark, sf_dir))


def expected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, expected): the files' page counts, one page more than they have blocks for in every third file."""
    n = F.max("page_num") + F.when(plants.part(F.max("file_id"), 3) == 0, 1).otherwise(0)
    return lines(spark, sf_dir).groupBy("file_id").agg(n.cast("int").alias("expected"))


def gappy(df: DataFrame) -> DataFrame:
    """Blocks of an extraction that lost a page in seven: what the coverage queries are asked about."""
    return df.where("page_num % 7 <> 3")


def chunked(df: DataFrame) -> DataFrame:
    """Chunks by the settings' sizes."""
    return chunks.chunks(df, SETTINGS.chunk_size, SETTINGS.chunk_overlap)


def few_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.numbered(lined_tables(spark, sf_dir))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image a document, as wide as its text is long modulo 150, with its length in bytes times ten."""
    n = F.length(F.coalesce("text", F.lit("")))
    return read(spark, sf_dir, "documents").select(B.file_of(), "doc_id", (n % 150).alias("width"), (n % 97).alias("height"), (n * 10).alias("bytes"))


@query
def block_summary(spark, sf_dir):
    return B.summary(processed(spark, sf_dir), lined_tables(spark, sf_dir), B.figures(images(spark, sf_dir)))


@query
def page_stats(spark, sf_dir):
    return B.page_stats(processed(spark, sf_dir))


@query
def blob_pages(spark, sf_dir):
    return B.blob_pages(processed(spark, sf_dir))


@query
def content_blocks(spark, sf_dir):
    return processed(spark, sf_dir).where(B.content()).select("doc_id", "seq", "type", T.strip(F.col("text")).alias("text"))


@query
def type_counts(spark, sf_dir):
    return typed(spark, sf_dir).groupBy("file_id", "type").agg(F.count("*").alias("n"))


@query
def repeating_lines(spark, sf_dir):
    return B.repeating(lines(spark, sf_dir))


@query
def contamination(spark, sf_dir):
    return B.contamination(lines(spark, sf_dir))


@query
def coverage(spark, sf_dir):
    return B.coverage(gappy(lines(spark, sf_dir)), lined_tables(spark, sf_dir), expected_pages(spark, sf_dir))


@query
def missing_pages(spark, sf_dir):
    return B.missing_pages(gappy(lines(spark, sf_dir)), lined_tables(spark, sf_dir), expected_pages(spark, sf_dir))


@query
def recovery_pages(spark, sf_dir):
    return B.pages_to_recover(gappy(processed(spark, sf_dir)), expected_pages(spark, sf_dir))


@query
def replaced_pages(spark, sf_dir):
    whole = read(spark, sf_dir, "documents").select("source", "doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), "\\n", " ").alias("text"))
    flat = B.blocks(whole).withColumn("origin", F.lit("flat"))
    found = B.pages_replaced(flat, lines(spark, sf_dir).withColumn("origin", F.lit("recovered")))
    return found.groupBy("file_id", "page_num", "origin").agg(F.count("*").alias("n"), F.sum(F.length("text")).cast("long").alias("chars"))


@query
def page_paragraphs(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").where("text IS NOT NULL")
    broken = docs.withColumn("text", F.when(F.col("doc_id") % 9 == 0, F.lit(" \n")).otherwise(F.regexp_replace("text", r"[.]\n", ".\n\n")))
    whole = B.blocks(broken.withColumn("text", F.lit(""))).drop("text", "seq").join(broken.select("doc_id", "text"), "doc_id")
    return B.paragraphs(whole).select("doc_id", "part", "block_id", "text")


@query
def noise_filter(spark, sf_dir):
    return B.noise_free(planted(spark, sf_dir)).select("doc_id", "seq", "type", "text")


@query
def boilerplate_tag(spark, sf_dir):
    return boilerplate.processed(planted(spark, sf_dir, True)).select("doc_id", "seq", "type", "boilerplate_type", "is_boilerplate")


@query
def boilerplate_counts(spark, sf_dir):
    found = boilerplate.processed(planted(spark, sf_dir, True))
    return found.groupBy("boilerplate_type", "type").agg(F.count("*").alias("n"), F.count_if("is_boilerplate").alias("boilerplate"))


@query
def heading_rescue(spark, sf_dir):
    found = boilerplate.rescued_headings(boilerplate.processed(planted(spark, sf_dir, True)))
    return found.groupBy("file_id", "type", "was_corrected").agg(F.count("*").alias("n"))


@query
def pyq_rescue(spark, sf_dir):
    found = boilerplate.rescued_questions(boilerplate.processed(planted(spark, sf_dir, True)))
    return found.groupBy("file_id", "type", "is_boilerplate", "boilerplate_type", "was_corrected").agg(F.count("*").alias("n"))


@query
def mojibake(spark, sf_dir):
    found = boilerplate.with_encoding_errors(boilerplate.processed(planted(spark, sf_dir, True)))
    return found.where("encoding_error IS NOT NULL").select("doc_id", "seq", "encoding_error")


@query
def toc_pages(spark, sf_dir):
    return boilerplate.toc_pages(boilerplate.with_types(boilerplate.with_repeats(boilerplate.tag(planted(spark, sf_dir)))))


@query
def stylized_headings(spark, sf_dir):
    return B.stylized(planted(spark, sf_dir).withColumn("type", F.lit("paragraph"))).select("doc_id", "seq", "type", "text")


@query
def split_collapsed(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 11 == 0, "caption").otherwise("paragraph").alias("type"), "text")
    return B.split_collapsed(docs)


@query
def label_types(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    labels = ("section_header", "list_item", "caption", "footnote", "page_header", "page_footer", "text")
    label = F.element_at(F.array(*(F.lit(x) for x in labels)), (F.col("doc_id") % 7 + 1).cast("int"))
    return docs.select("doc_id", B.label_type(label).alias("type"))


@query
def font_types(spark, sf_dir):
    df = planted(spark, sf_dir)
    y0, size = 842 - F.col("y0"), F.when(F.length("text") % 3 == 0, 12.0).otherwise(10.0)
    first = B.font_type(F.col("text"), y0, size)
    return df.select("doc_id", "seq", first.alias("first"), B.font_type(F.col("text"), y0, size, margins=(0.07, 0.93), below=120).alias("second"))


@query
def highlight_colors(spark, sf_dir):
    r, g, b = (F.floor(F.col("doc_id") / d) % 10 * 28 + 3 for d in (1, 10, 100))
    return read(spark, sf_dir, "documents").select("doc_id", B.highlight(r, g, b).alias("highlight"))


@query
def block_background(spark, sf_dir):
    """Three pixels left of each block's middle, of the colours that its text gives, on images of two pixels a point."""
    df = B.with_box(lines(spark, sf_dir))
    sizes = df.select("file_id", "page_num").distinct().selectExpr("*", "612 AS width", "842 AS height", "1224 AS image_width", "1684 AS image_height")
    px = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")
    spots = df.select("file_id", "page_num", "x0", "y0", F.length("text").alias("n"), px)
    colour = lambda f: ((F.col("n") * f + F.col("k") * 40) % 256).cast("int")
    x, y = F.col("x0") * 2 - 5 - F.col("k"), 1684 - (F.col("y0") + 6) * 2
    pixels = spots.select("file_id", "page_num", x.alias("x"), y.alias("y"), colour(7).alias("r"), colour(11).alias("g"), colour(13).alias("b"))
    found = B.background(df, pixels, sizes)
    return found.withColumn("highlight", B.highlight(F.col("r"), F.col("g"), F.col("b")))


@query
def placeholder_boxes(spark, sf_dir):
    df = B.with_box(lines(spark, sf_dir))
    whole = F.length("text") % 10 == 0
    box = [F.when(whole, v).otherwise(F.col(c).cast("double")) for c, v in zip(("x0", "y0", "x1", "y1"), P.FULL_PAGE_BOXES[0], strict=True)]
    return df.select("file_id", B.placeholder_box(*box).alias("p")).groupBy("file_id").agg(F.count_if("p").alias("placeholders"), F.count("*").alias("blocks"))


@query
def page_figures(spark, sf_dir):
    return B.figures(images(spark, sf_dir)).drop("file_id")


@query
def llm_summaries(spark, sf_dir):
    pages = B.blocks(plants.planted(read(spark, sf_dir, "documents"))).groupBy("file_id", "page_num").agg(F.collect_list("text").alias("texts"))
    return pages.where(B.summary_like(F.col("texts"))).select("file_id", "page_num")


@query
def blank_page_check(spark, sf_dir):
    marked = lines(spark, sf_dir).groupBy("file_id", "page_num").agg(F.min("doc_id").alias("doc_id"))
    df = marked.select("file_id", "page_num", "doc_id", F.when(F.col("page_num") % 2 == 0, "blank_page").otherwise("paragraph").alias("type"))
    return B.without_tabled_blanks(df, lined_tables(spark, sf_dir)).select("file_id", "page_num", "type")


@query
def page_range(spark, sf_dir):
    return B.page_range(lines(spark, sf_dir), 2, 3).groupBy("file_id", "page_num").agg(F.count("*").alias("n"))


@query
def patched_order(spark, sf_dir):
    return B.page_order(sequences.reindexed(lines(spark, sf_dir))).select("doc_id", "seq", "position")


@query
def page_texts(spark, sf_dir):
    return B.page_texts(processed(spark, sf_dir))


@query
def reading_order(spark, sf_dir):
    df = planted(spark, sf_dir)
    lost = F.length("text") % 17 == 3
    boxless = df.withColumns({c: F.when(~lost, F.col(c)) for c in ("x0", "y0", "x1", "y1")})
    return sequences.reading_order(boxless).select("doc_id", "seq", "position")


@query
def page_extents(spark, sf_dir):
    return sequences.page_extents(B.with_box(lines(spark, sf_dir)))


def widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known widths of the pages with even numbers."""
    pages = lines(spark, sf_dir).select("file_id", "page_num").distinct().where("page_num % 2 = 0")
    return pages.withColumn("page_width", F.lit(595.0) + F.col("page_num") % 5)


@query
def column_midpoint(spark, sf_dir):
    return sequences.column_midpoint(B.with_box(lines(spark, sf_dir)), widths(spark, sf_dir))


@query
def page_reorder(spark, sf_dir):
    return sequences.page_reorder(B.with_box(lines(spark, sf_dir)), widths(spark, sf_dir)).select("doc_id", "seq", "position")


@query
def block_ids(spark, sf_dir):
    return sequences.reindexed(lines(spark, sf_dir)).select("doc_id", "seq", "block_id")


@query
def consecutive_dedup(spark, sf_dir):
    return sequences.consecutive_dedup(planted(spark, sf_dir)).select("doc_id", "seq", "text")


@query
def heading_dedup(spark, sf_dir):
    return sequences.headings_deduped(planted(spark, sf_dir)).select("doc_id", "seq", "text")


@query
def caption_join(spark, sf_dir):
    return sequences.captions_joined(planted(spark, sf_dir)).select("doc_id", "seq", "type", "text")


@query
def cross_page_merge(spark, sf_dir):
    return sequences.sentences_merged(processed(spark, sf_dir)).select("doc_id", "seq", "text", "was_corrected")


@query
def unmerged_splits(spark, sf_dir):
    return sequences.unmerged_splits(processed(spark, sf_dir))


@query
def callout_runs(spark, sf_dir):
    colour = F.when(F.length("text") % 4 == 0, "pink_callout").when(F.length("text") % 4 == 1, "blue_callout")
    return sequences.colour_runs(lines(spark, sf_dir), colour).select("doc_id", "seq", "highlight_type", "box_id")


@query
def blank_markers(spark, sf_dir):
    short = F.col("is_boilerplate") | (F.length("text") < 60)
    return sequences.blank_markers(processed(spark, sf_dir).withColumn("is_boilerplate", short))


@query
def blank_marked(spark, sf_dir):
    """Blocks with the markers of blank pages among them."""
    short = F.col("is_boilerplate") | (F.length("text") < 60)
    found = sequences.with_blank_markers(processed(spark, sf_dir).withColumn("is_boilerplate", short))
    return found.select("file_id", "page_num", "doc_id", "seq", "type", "position")


def recognised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' lines as recognised lines with places on a page of 1000 x 1400 pixels."""
    df = B.blocks(plants.planted(read(spark, sf_dir, "documents")))
    return df.select(
        "file_id", "page_num", F.col("seq").alias("line_no"), T.strip(F.col("text")).alias("text"), F.when(F.col("seq") % 2 == 0, 250.0).otherwise(750.0).alias("xc"),
        (F.lit(60.0) + (F.col("seq") * 37) % 1300).alias("yc"), F.lit(1000.0).alias("width"), F.lit(1400.0).alias("height"),
    )


@query
def line_zones(spark, sf_dir):
    return sequences.zoned_blocks(recognised(spark, sf_dir))


@query
def paragraph_breaks(spark, sf_dir):
    df = recognised(spark, sf_dir).where("text <> ''")
    y, x = F.col("line_no") * 30.0, F.when(F.length("text") % 7 == 0, 60.0).otherwise(40.0)
    high = 18.0 - F.length("text") % 3 * 6
    shaped = df.select("file_id", "page_num", F.lit(1).alias("column"), "line_no", "text", x.alias("min_x"), y.alias("min_y"), (y + high).alias("max_y"))
    return sequences.column_blocks(shaped)


@query
def page_dedup(spark, sf_dir):
    part = F.concat_ws("/", "lang", F.floor(F.col("doc_id") / 1000).cast("string"))
    pages = read(spark, sf_dir, "documents").select(part.alias("file_id"), F.col("doc_id").alias("page_num"), F.coalesce("text", F.lit("")).alias("text"))
    return sequences.page_dedup(pages, P.SAME_TOPIC_WORDS).select("file_id", "page_num")


@query
def covered_blocks(spark, sf_dir):
    """White rectangles over every tenth line: those of 200 points hide what is narrow enough, those of 600 are too large."""
    boxed = B.with_box(lines(spark, sf_dir))
    drawn = boxed.where("seq % 5 = 0").select(
        "file_id", "page_num", F.col("x0").alias("rx0"), (F.col("y0") - 20).alias("ry0"),
        (F.col("x0") + F.when(F.col("seq") % 15 == 0, 600).otherwise(200)).alias("rx1"), (F.col("y1") + F.when(F.col("seq") % 15 == 0, 60).otherwise(1)).alias("ry1"),
        *(F.when(F.col("seq") % 10 == 0, 0.95).otherwise(0.9).alias(c) for c in "rgb"),
    )
    sizes = boxed.select("file_id", "page_num").distinct().where("page_num % 2 = 0").selectExpr("*", "595.0D AS width", "842.0D AS height")
    return sequences.covered(boxed, sequences.white_rects(drawn, sizes)).select("doc_id", "seq")


@query
def normalize_text(spark, sf_dir):
    return lines(spark, sf_dir).select("doc_id", "seq", T.normalized(F.col("text")).alias("text"))


@query
def correct_text_basic(spark, sf_dir):
    return plants.planted(read(spark, sf_dir, "documents")).select("doc_id", T.basic_correction(F.col("text")).alias("text"))


@query
def correct_text(spark, sf_dir):
    found = T.corrected_blocks(B.blocks(plants.planted(read(spark, sf_dir, "documents"))))
    return found.select("doc_id", "seq", "text", "raw_text", "was_corrected")


@query
def fenced_answers(spark, sf_dir):
    fenced = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("```json\n"), F.coalesce("text", F.lit("")), F.lit("\n```"))).otherwise(F.coalesce("text", F.lit("")))
    return read(spark, sf_dir, "documents").select("doc_id", T.without_fences(fenced).alias("text"))


@query
def chunk_fold(spark, sf_dir):
    listed = lambda c: F.concat_ws(",", F.transform(c, lambda x: x.cast("string")))
    return chunked(lines(spark, sf_dir)).select("doc_id", "chunk_id", "text", "character_count", listed("block_ids").alias("block_ids"), listed("pages").alias("pages"))


@query
def chunk_documents(spark, sf_dir):
    """Chunk documents written as JSON into container files and read back."""
    path = store.shared_folder(spark)
    files.write_chunks(chunks.documents(chunked(lines(spark, sf_dir))), path)
    found = files.read_chunks(spark, path)
    listed = lambda c: F.concat_ws(",", F.transform(c, lambda x: x.cast("string")))
    return found.select("file_id", "chunk_id", "text", "character_count", listed("page_numbers").alias("pages"), F.concat_ws(",", "block_ids").alias("block_ids"))


@query
def chunk_stats(spark, sf_dir):
    return chunks.stats(chunked(lines(spark, sf_dir)))


@query
def chunk_totals(spark, sf_dir):
    return chunks.totals(chunked(lines(spark, sf_dir)))


@query
def point_ids(spark, sf_dir):
    return chunked(lines(spark, sf_dir)).select("doc_id", "chunk_id", T.uuid5(F.concat_ws(":", F.col("doc_id").cast("string"), "chunk_id")).alias("point_id"))


@query
def upsert(spark, sf_dir):
    old = read(spark, sf_dir, "documents").select("doc_id", "lang", F.lit("old").alias("version"))
    new = read(spark, sf_dir, "labels").where("doc_id % 2 = 0").select("doc_id", F.lit("x").alias("lang"), F.lit("new").alias("version"))
    return registry.upserted(old, new.unionByName(new.withColumn("doc_id", -F.col("doc_id") - 1)), "doc_id")


@query
def status_update(spark, sf_dir):
    old = read(spark, sf_dir, "documents").select("doc_id", F.lit("registered").alias("status"), F.lit(None).cast("string").alias("error"))
    failed = F.col("quality") == 0
    new = read(spark, sf_dir, "labels").select("doc_id", F.when(failed, "failed").alias("status"), F.when(failed, "low quality").alias("error"))
    return registry.changed(old, new, "doc_id")


@query
def upserted_documents(spark, sf_dir):
    """The documents put into a table of upserts, then those with a label again, in their last form, twice under one number."""
    docs, path = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.lit(0).alias("version")), store.shared_folder(spark)
    changed = docs.join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").select("doc_id", F.concat("text", F.lit("!")).alias("text"), "lang", (F.col("quality") + 1).cast("int").alias("version"))
    for batch, df in ((0, docs), (1, changed), (1, docs.withColumn("version", F.lit(9)))):
        upserts.upsert(df, path, batch)
    return upserts.current(spark, path, "doc_id long, text string, lang string, version int", "doc_id").select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "lang", "version")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))


@query
def latest_status(spark, sf_dir):
    return registry.latest(events(spark, sf_dir), "user_id", "event_id", ["event_type", "value"])


@query
def latest_status_stream(spark, sf_dir):
    """The same rows from a stream of the events out of order, in four files, one a micro-batch."""
    folder = store.shared_folder(spark)
    events(spark, sf_dir).repartition(4, F.xxhash64("event_id")).write.parquet(f"{folder}/events")
    fields = {"event_type": "string", "value": "double"}
    stream = spark.readStream.schema("user_id long, event_id long, event_type string, value double").option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")
    lifecycle.followed(lifecycle.lifecycle(stream, "user_id", "event_id", fields), f"{folder}/table", f"{folder}/state").awaitTermination()
    return upserts.current(spark, f"{folder}/table", "user_id long, event_id long, event_type string, value double, final boolean", "user_id", "event_id").drop("final")


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads with their class and name, some of which are not allowed."""
    name = F.concat(F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 7 == 0, ".txt").when(F.col("doc_id") % 2 == 0, ".PDF").otherwise(".pdf"))
    kind = F.when(F.col("lang") == "en", "History").when(F.col("lang") == "de", "Anthropology").otherwise(F.col("lang"))
    return read(spark, sf_dir, "documents").select("doc_id", name.alias("file_name"), kind.alias("classification"), F.length("text").alias("n"))


@query
def upload_intake(spark, sf_dir):
    found = registry.intake(uploads(spark, sf_dir), list(SETTINGS.classes))
    path = registry.upload_path(SETTINGS.upload_folder, F.col("classification"), F.col("doc_id").cast("string"))
    place = registry.collection(F.col("classification"), {"History": "history_chunks", "Anthropology": "anthropology_chunks"})
    return found.select("doc_id", "error", F.when(F.col("error").isNull(), path).alias("path"), place.alias("collection"))


@query
def engine_route(spark, sf_dir):
    """Files dealt to the engines by whether they are scanned, some with a forced engine."""
    found = scan_type(spark, sf_dir)
    forced = F.when(plants.part("file_id", 5) == 0, "VLM").when(plants.part("file_id", 5) == 1, "layout")
    return found.select("file_id", registry.engine(F.col("scanned"), forced).alias("engine"))


@query
def ingest_stats(spark, sf_dir):
    """A batch of documents, and of pages that nothing was chunked of."""
    found = chunked(lines(spark, sf_dir)).withColumn("file_id", F.col("doc_id").cast("string"))
    files_ = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file_id"))
    files_ = files_.unionByName(read(spark, sf_dir, "pages").select(F.concat(F.lit("page-"), "page_id").alias("file_id")))
    wet = registry.ingest_stats(files_, found).withColumn("run", F.lit("run"))
    return wet.unionByName(registry.ingest_stats(files_, found, dry_run=True).withColumn("run", F.lit("dry")))


@query
def failed_files(spark, sf_dir):
    return ingest_stats(spark, sf_dir).where("status = 'error'").select("run", "file_id", "error")


@query
def batch_progress(spark, sf_dir):
    return registry.progress(read(spark, sf_dir, "documents").select(F.concat_ws("/", "source", F.format_string("%d.pdf", "doc_id")).alias("path")))


@query
def registry_response(spark, sf_dir):
    times = [F.col("ts").alias(c) for c in ("created_at", "updated_at")]
    return registry.response(read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("status"), *times))


@query
def status_funnel(spark, sf_dir):
    """Documents by the last status that they reached."""
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    status = F.when(F.col("quality").isNull(), "registered").when(F.col("quality") == 0, "failed").when(F.col("toxic") == 1, "extracted").otherwise("ingested")
    return read(spark, sf_dir, "documents").join(labels, "doc_id", "left").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query
def knn_top10(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    return vectors.nearest(v.where("vec_id % 50 = 0"), v).select("query_id", "vec_id", "score", "rank")


@query
def recall_mrr_ndcg(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    queries = v.where("vec_id % 50 = 0")
    return vectors.evaluation(vectors.nearest(queries, v), queries)


@query
def hashed_embedding(spark, sf_dir):
    found = vectors.embedded(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.posexplode(F.transform("vector", lambda x: F.round(x, 6))).alias("place", "value")).where("value > 0")


@query
def embedding_misfits(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    cut = v.withColumn("embedding", F.slice("embedding", 1, (64 - F.col("vec_id") % 3).cast("int")))
    return vectors.misfits(cut, 64, "embedding").select("vec_id")


def placed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with their place as a number: the document's in the upper bits, the chunk's own in the lower 31."""
    found = chunked(B.blocks(plants.planted(read(spark, sf_dir, "documents"))))
    return found.select((F.shiftleft(F.col("doc_id"), 31) + F.col("chunk_no")).alias("place"), "text")


@query
def query_synthesis(spark, sf_dir):
    found = vectors.asked(placed_chunks(spark, sf_dir), "place")
    return found.select("query", F.format_string("%012d/chk_%04d", F.shiftright("expected", 31), F.col("expected").bitwiseAND((1 << 31) - 1)).alias("expected"))


def retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = store.written(placed_chunks(spark, sf_dir))
    return vectors.retrieved(found, vectors.asked(found, "place"), vectors.embedded)


@query
def retrieval_report(spark, sf_dir):
    """(query, rank): the place of each synthesized query's chunk among the ten nearest chunks, 0 if it isn't there."""
    return retrieval(spark, sf_dir).select("query", "rank")


@query
def retrieval_measures(spark, sf_dir):
    """One row a model: the measures of its lists for the synthesized queries."""
    return vectors.measures(retrieval(spark, sf_dir)).select(F.lit("hashed words").alias("model"), F.lit(64).alias("dims"), "*")


@query
def ner_counts(spark, sf_dir):
    return entities.label_counts(B.blocks(plants.planted(read(spark, sf_dir, "documents"))))


@query
def ner_frequencies(spark, sf_dir):
    return entities.frequencies(entities.with_entities(B.blocks(plants.planted(read(spark, sf_dir, "documents")))))


@query
def ner_spans(spark, sf_dir):
    found = entities.with_entities(B.blocks(plants.planted(read(spark, sf_dir, "documents"))))
    return found.select("doc_id", "seq", F.size("entities").alias("n"), F.to_json("entities").alias("entities")).where("n > 0")


@query
def ner_totals(spark, sf_dir):
    found = entities.with_entities(B.blocks(plants.planted(read(spark, sf_dir, "documents"))))
    return entities.totals(found)


@query
def table_filter(spark, sf_dir):
    t = tables.numbered(lined_tables(spark, sf_dir))
    return t.select("doc_id", "row_count", "column_count", tables.toc_like(F.col("rows")).alias("toc_like"))


@query
def degenerate_tables(spark, sf_dir):
    return lined_tables(spark, sf_dir).select("doc_id", tables.degenerate(F.col("headers"), F.col("rows")).alias("reason"))


@query
def table_headers(spark, sf_dir):
    digits = F.transform("headers", lambda h: F.when(F.col("doc_id") % 2 == 0, F.length(h).cast("string")).otherwise(h))
    return lined_tables(spark, sf_dir).select("doc_id", F.array_join(tables.clean_headers(digits), "|").alias("headers"))


def damaged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with a citation as last row, a phantom column in every third, and placeholders in every second."""
    cited = F.array(F.array(F.lit("(Adapted from Unit 3)"), F.lit("")), F.array(F.lit("(Source: p. 7)")))
    phantom = F.col("doc_id") % 3 == 0
    marked = lambda c: F.when((F.col("doc_id") % 2 == 0) & (F.length(c) % 4 == 0), F.concat(c, F.lit("<!-- image -->"))).otherwise(c)
    rows = F.transform("rows", lambda r: F.concat(F.when(phantom, F.array(F.lit("Page Nos."))).otherwise(F.array().cast("array<string>")), F.transform(r, marked)))
    headers = F.concat(F.when(phantom, F.array(F.lit("BHIC-101"))).otherwise(F.array().cast("array<string>")), F.transform("headers", marked))
    caption = F.when(F.col("doc_id") % 4 == 0, "A caption").otherwise("")
    last = F.when(phantom, F.array().cast("array<array<string>>")).otherwise(cited)
    return lined_tables(spark, sf_dir).withColumns({"rows": F.concat(rows, last), "headers": headers, "caption": caption})


@query
def table_repair(spark, sf_dir):
    t = tables.numbered(tables.repaired(damaged_tables(spark, sf_dir)))
    cells = F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "/")
    return t.select("doc_id", "table_id", "caption", "row_count", "column_count", F.array_join("headers", "|").alias("headers"), cells.alias("cells"))


def doubtful_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of which some have dot leaders and others are cut to one cell."""
    t = lined_tables(spark, sf_dir)
    dots = F.transform("rows", lambda r: F.transform(r, lambda c: F.concat(c, F.lit(" ....... 7"))))
    one = F.array(F.array(F.concat(F.lit("only cell "), F.col("doc_id").cast("string"))))
    rows = F.when(F.col("doc_id") % 3 == 0, dots).when(F.col("doc_id") % 3 == 1, one).otherwise(F.col("rows"))
    return t.withColumns({"rows": rows, "headers": F.when(F.col("doc_id") % 3 == 1, F.slice("headers", 1, 1)).otherwise(F.col("headers"))})


@query
def table_review(spark, sf_dir):
    return tables.kept(doubtful_tables(spark, sf_dir)).select("doc_id", "needs_review", F.size("rows").alias("row_count"))


@query
def table_row_rescue(spark, sf_dir):
    return tables.rescued_rows(doubtful_tables(spark, sf_dir), lines(spark, sf_dir))


def audited(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, blocks, tables) of an audit: files that are lost, broken, unnamed or lack their last page, blocks without
    tags, entities or with whole-page boxes, tables without rows."""
    df = processed(spark, sf_dir)
    mark = plants.part("file_id", 1 << 32)
    found = expected_pages(spark, sf_dir).withColumns({
        "there": mark % 11 != 0, "corrupt": mark % 13 == 0, "file_name": F.when(mark % 7 != 0, F.col("file_id")), "extracted_at": F.lit("2024-01-01T00:00:00+00:00"),
        "chunked": mark % 6 != 0,
    })
    whole = F.length("text") % 50 == 7
    box = {c: F.when(whole, v).otherwise(F.col(c).cast("double")) for c, v in zip(("x0", "y0", "x1", "y1"), P.FULL_PAGE_BOXES[0], strict=True)}
    some = F.when(F.col("text").rlike(r"\d{4}"), F.array(F.lit("year"))).otherwise(F.array().cast("array<string>"))
    df = df.withColumns(box | {"is_boilerplate": F.when(mark % 8 != 0, F.col("is_boilerplate")), "entities": F.when(mark % 9 != 0, some)})
    t = few_tables(spark, sf_dir).withColumn("rows", F.when(F.col("doc_id") % 10 != 0, F.col("rows")))
    return found, df, t


@query
def qa_rules(spark, sf_dir):
    found, df, t = audited(spark, sf_dir)
    return audit.rules(found, df, t)


@query
def evaluation(spark, sf_dir):
    return audit.evaluated(*audited(spark, sf_dir))


@query
def rating_rollup(spark, sf_dir):
    return audit.ratings(audit.evaluated(*audited(spark, sf_dir)), F.left("file_id", F.lit(4)))


@query
def audit_report(spark, sf_dir):
    return audit.report(audit.evaluated(*audited(spark, sf_dir)))


@query
def corpus_report(spark, sf_dir):
    return audit.sections(audit.evaluated(*audited(spark, sf_dir)))


@query
def batch_checks(spark, sf_dir):
    found, df, _ = audited(spark, sf_dir)
    counts = chunked(lines(spark, sf_dir)).groupBy("file_id").agg(F.count("*").alias("chunk_count")).where(plants.part("file_id", 4) != 0)
    return audit.batch_checks(found, df, counts)


@query
def scan_type(spark, sf_dir):
    """Pages of whole documents; in every third file the pages hold a watermark alone, in every other third newlines."""
    place = B.blocks(read(spark, sf_dir, "documents").withColumn("text", F.lit("")))
    d = place.drop("text", "seq").join(read(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")
    text = F.when(plants.part("file_id", 3) == 0, F.col("lang")).when(plants.part("file_id", 3) == 1, F.repeat(F.lit("\n"), F.lit(200)))
    text = text.otherwise(F.coalesce("text", F.lit("")))
    return files.scanned(d.groupBy("file_id", "page_num").agg(F.array_join(F.array_sort(F.collect_list(text)), " ").alias("text")))


@query
def file_match(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.concat_ws("/", "source", F.format_string("%d.pdf", "doc_id")).alias("path"))
    stem = F.regexp_replace("path", r"\.pdf$", "")
    source = read(spark, sf_dir, "documents").select("doc_id", "source")
    labels = read(spark, sf_dir, "labels").join(source, "doc_id").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("stem"))
    return registry.matched(d.select(stem.alias("stem")), labels, "stem")


@query
def html_blocks(spark, sf_dir):
    return html.html_blocks(read(spark, sf_dir, "pages"))


@query
def html_elements(spark, sf_dir):
    """The blocks of web pages through the data source."""
    return elements.read_elements(spark, f"{sf_dir}/pages.parquet")


@query
def json_blocks(spark, sf_dir):
    """Whole documents as a model's answers: an array of their lines, or one object for a document of one line."""
    kind = F.when(F.col("seq") % 3 != 0, F.when(F.col("seq") % 5 == 0, "footer").otherwise("list_item"))
    box = F.when(F.col("seq") % 4 == 0, F.array(F.col("seq").cast("double"), F.lit(1.5), F.lit(2.0), F.lit(3.0))).alias("bbox")
    block = F.struct("seq", F.struct(kind.alias("type"), "text", box, (F.col("seq") % 5 == 0).alias("is_boilerplate")).alias("b"))
    d = lines(spark, sf_dir).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(block)), lambda x: x["b"]).alias("bs"))
    answer = lambda bs: F.when(F.size(bs) == 1, F.to_json(F.get(bs, F.lit(0)))).otherwise(F.concat(F.lit("```json\n"), F.to_json(bs), F.lit("\n```")))
    raw = T.named(F.col("bs"), answer)
    found = files.normalized_blocks(d.select("doc_id", raw.alias("raw")), "raw")
    return found.withColumn("bbox", F.concat_ws(",", F.transform("bbox", lambda x: x.cast("decimal(12,1)").cast("string")))).drop("entities")


@query
def document_json(spark, sf_dir):
    """Files' nested documents, written as JSON and read back."""
    df = processed(spark, sf_dir)
    named = df.select("file_id").distinct().select("file_id", F.concat("file_id", F.lit(".pdf")).alias("file_name"), F.lit("2024-01-01").alias("extracted_at"))
    shape = """document_metadata struct<file_name:string>, extraction_summary struct<content_blocks:long,table_count:long,image_count:long,total_ner_entities:long>,
      text_blocks array<struct<doc_id:long,seq:int,type:string,text:string,is_boilerplate:boolean>>, tables array<struct<rows:array<array<string>>>>"""
    digits = F.when(F.col("text").rlike("[0-9]"), F.array(F.struct(F.lit("n").alias("text"), F.lit("NUMBER").alias("label"))))
    renders = df.where("type = 'heading'").select("file_id", "page_num", F.concat_ws("-", "doc_id", "seq").alias("filename"))
    whole = files.assembled(df.withColumn("entities", digits), named, few_tables(spark, sf_dir).withColumn("caption", F.lit("")), renders)
    read_back = whole.select("file_id", F.from_json("document", shape).alias("d"))
    rows = read_back.select("d.document_metadata.file_name", "d.extraction_summary.*", F.size("d.tables").alias("tables"), F.explode("d.text_blocks").alias("b"))
    return rows.select("file_name", "content_blocks", "table_count", "image_count", "total_ner_entities", "tables", "b.*")
