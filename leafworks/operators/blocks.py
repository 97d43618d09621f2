"""Blocks of documents: the derived frames, noise filters, classes, page statistics and page sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafworks.functions import patterns as P
from leafworks.functions import text as T

PAGE_HEIGHT = 842
#: Documents of one source that make a file: 100 pages, so a window over a file has a bounded number of rows.
FILE_DOCS, PAGE_DOCS = 2000, 20


def file_of() -> Column:
    """The file of a document, by its source and id."""
    return F.concat_ws("-", "source", F.floor(F.col("doc_id") / FILE_DOCS).cast("string")).alias("file_id")


def by_file(documents: DataFrame) -> DataFrame:
    """(doc_id, source, text, file_id) of the documents, dealt over tasks by their file: what is asked of whole files then
    moves nothing any more."""
    return documents.select("doc_id", "source", "text", file_of()).repartition("file_id")


def blocks(documents: DataFrame) -> DataFrame:
    """(file_id, page_num, doc_id, seq, text): a block per line; 20 files share the pages in turn. documents: as they are, or
    from by_file()."""
    place = F.pmod("doc_id", F.lit(FILE_DOCS))
    file_id = F.col("file_id") if "file_id" in documents.columns else file_of()
    page_num = (F.floor(place / PAGE_DOCS) + 1).cast("int").alias("page_num")
    lines = F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("seq", "text")
    return documents.select(file_id, page_num, "doc_id", lines)


def with_box(df: DataFrame) -> DataFrame:
    """Adds x0, y0, x1, y1 (high y is the top): boxes by whole-number arithmetic for frames that have none."""
    length = F.length("text")
    x0 = F.when(length % 5 == 0, 20).otherwise(F.when(F.col("seq") % 2 == 0, 40).otherwise(320))
    y0, x1 = 840 - (F.col("seq") % 42) * 20, x0 + F.when(length % 5 == 0, 540).otherwise(60 + length % 180)
    return df.withColumns({"x0": x0, "y0": y0, "x1": x1, "y1": y0 + 12})


def boilerplate(df: DataFrame) -> Column:
    """Whether a block is boilerplate; null, or no such column: it isn't."""
    return F.coalesce("is_boilerplate", F.lit(False)) if "is_boilerplate" in df.columns else F.lit(False)


def content() -> Column:
    """Whether a block has text and isn't boilerplate (null: it isn't)."""
    return ~F.coalesce(F.col("is_boilerplate"), F.lit(False)) & (T.strip(F.col("text")) != "")


def noise_free(df: DataFrame) -> DataFrame:
    """Without blank blocks (but markers of blank pages stay), icon tokens, lone digits or hyphens in paragraphs and
    footers, and year marks."""
    text = T.strip(F.col("text"))
    single = text.rlike(P.SINGLE_MARK) & F.col("type").isin("paragraph", "footer")
    filled = (text != "") | (F.col("type") == "blank_page")
    return df.where(filled & ~F.lower(text).isin(P.GARBAGE_TOKENS) & ~F.coalesce(single, F.lit(False)) & ~text.rlike(P.YEAR_MARK))


def stylized(df: DataFrame) -> DataFrame:
    """Broken handwritten headings put right; paragraphs that held one become headings."""
    fixed = T.replaced(F.col("text"), P.STYLIZED_HEADINGS)
    hit = T.matches(F.col("text"), [p for p, _ in P.STYLIZED_HEADINGS]) & (F.col("type") == "paragraph")
    return df.withColumns({"type": F.when(hit, "heading").otherwise(F.col("type")), "text": fixed})


def block_type(name: str = "text") -> Column:
    """A block's type by its text: list item, heading, footer or paragraph."""
    text = F.col(name)
    t = T.strip(text)
    return (
        F.when(t == "", "blank").when(t.rlike(P.FOOTER_NUMBER), "footer").when(F.lower(t).isin(P.HEADER_PHRASES), "header")
        .when(T.matches(t, P.HEADINGS), "heading").when(text.rlike(P.LIST_ITEM), "list_item")
        .when((F.length(t) < 60) & t.rlike(r"^[A-Z0-9#]") & ~t.rlike(r"[.!?:,;]$"), "heading").otherwise("paragraph")
    )


def font_type(text: Column, y0: Column, size: Column, height: float = PAGE_HEIGHT, margins: tuple[float, float] = (0.06, 0.93), below: int = 100) -> Column:
    """A block's type by place (low y is the top) and font; margins and `below` differ between the two uses."""
    out = F.when(y0 > height * margins[1], "footer").when(y0 < height * margins[0], "header")
    out = out.when((size >= 11) & (F.length(text) < below), "heading")
    return out.when(text.rlike(P.FONT_LIST_ITEM if below == 100 else P.FONT_LIST_ITEM_MORE), "list_item").otherwise("paragraph")


def label_type(label: Column) -> Column:
    """A layout label's block type; the first substring that it holds decides."""
    low = F.lower(label)
    out = F.when(T.has_any(low, ["heading", "title", "section"]), "heading")
    for word, kind in (("list", "list_item"), ("caption", "caption"), ("footnote", "footnote"), ("header", "header"), ("footer", "footer")):
        out = out.when(low.contains(word), kind)
    return out.otherwise("paragraph")


def repeating(df: DataFrame, min_pages: int = 3, below: int = 120) -> DataFrame:
    """(file_id, line, pages): stripped texts shorter than `below` on min_pages pages of a file or more."""
    line = T.strip(F.col("text"))
    short = df.select("file_id", "page_num", line.alias("line")).where((F.length("line") > 0) & (F.length("line") < below))
    return short.groupBy("file_id", "line").agg(F.countDistinct("page_num").alias("pages")).where(F.col("pages") >= min_pages)


def summary(df: DataFrame, tables: DataFrame, images: DataFrame) -> DataFrame:
    """A row per file: all, content, boilerplate and corrected blocks, tables, images, and code points."""
    bad = boilerplate(df)
    counts = df.groupBy("file_id").agg(
        F.count("*").alias("total_blocks"), F.count_if(~bad).alias("content_blocks"), F.count_if(bad).alias("boilerplate_blocks"),
        F.count_if(F.coalesce("was_corrected", F.lit(False))).alias("corrected_blocks"), F.sum(F.length("text")).cast("long").alias("chars"),
    )
    for name, frame in (("table_count", tables), ("image_count", images)):
        found = frame.groupBy("file_id").agg(F.count("*").alias(name))
        counts = counts.join(found, "file_id", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return counts


def page_stats(df: DataFrame) -> DataFrame:
    """(file_id, page_num, chars, content_blocks, longest): blocks that aren't boilerplate, and the longest of them."""
    own = ~boilerplate(df)
    longest = F.coalesce(F.max(F.when(own, F.length("text"))), F.lit(0))
    return df.groupBy("file_id", "page_num").agg(F.sum(F.length("text")).cast("long").alias("chars"), F.count_if(own).alias("content_blocks"), longest.alias("longest"))


def blob_pages(df: DataFrame, most: int = 3, over: int = 400) -> DataFrame:
    """Pages of few content blocks, one of them long."""
    return page_stats(df).where((F.col("content_blocks") <= most) & (F.col("longest") > over))


def pages_to_recover(df: DataFrame, expected: DataFrame, least_chars: int = 20) -> DataFrame:
    """(file_id, page_num, missing, low, blob) of expected pages without blocks, with hardly any text, or collapsed
    into a few blocks. expected: (file_id, expected) pages."""
    pages = expected.select("file_id", F.explode(F.sequence(F.lit(1), F.col("expected"))).alias("page_num"))
    stats = page_stats(df).withColumn("there", F.lit(True))
    found = pages.join(stats, ["file_id", "page_num"], "left").select(
        "file_id", "page_num", F.col("there").isNull().alias("missing"), (F.coalesce("chars", F.lit(0)) < least_chars).alias("low"),
        F.coalesce((F.col("content_blocks") <= 3) & (F.col("longest") > 400), F.lit(False)).alias("blob"),
    )
    return found.where("missing OR low OR blob")


def pages_replaced(df: DataFrame, recovered: DataFrame, most: int = 3, over: int = 400) -> DataFrame:
    """df with the blocks of collapsed pages (few blocks of any kind, one of them long) replaced by those of
    recovered, where these are more than one; both have the same columns."""
    page = ["file_id", "page_num"]
    blob = df.groupBy(*page).agg(F.count("*").alias("n"), F.max(F.length("text")).alias("m")).where((F.col("n") <= most) & (F.col("m") > over))
    better = recovered.groupBy(*page).agg(F.count("*").alias("n")).where("n > 1").select(*page).join(blob.select(*page), page, "left_semi")
    return df.join(better, page, "left_anti").unionByName(recovered.join(better, page, "left_semi"), allowMissingColumns=True)


def paragraphs(df: DataFrame) -> DataFrame:
    """(file_id, page_num, doc_id, part, block_id, text): the paragraphs between blank lines of whole texts; a text
    without any gives one that says so. df: file_id, page_num, doc_id, text."""
    text = T.strip(F.coalesce("text", F.lit("")))
    shown = F.when(text == "", F.format_string("[Empty Page: Page %d has no text or image content]", "page_num")).otherwise(text)
    parts = F.filter(F.transform(F.split(shown, "\n\n"), lambda x: T.strip(x)), lambda x: x != "")
    rows = df.select("file_id", "page_num", "doc_id", F.posexplode(parts).alias("k", "text"))
    block_id = F.format_string("blk_fallback_p%04d_%03d", "page_num", F.col("k") + 1)
    return rows.select("file_id", "page_num", "doc_id", (F.col("k") + 1).alias("part"), block_id.alias("block_id"), "text")


def page_texts(df: DataFrame) -> DataFrame:
    """(file_id, page_num, text): each page's content blocks but headers and footers, in order, joined by spaces."""
    own = ~boilerplate(df) & ~F.col("type").isin("header", "footer")
    ordered = F.array_sort(F.collect_list(F.when(own, F.struct("doc_id", "seq", "text"))))
    return df.groupBy("file_id", "page_num").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("text"))


def contamination(df: DataFrame, over: int = 40) -> DataFrame:
    """Distinct long texts per file that stand on several pages."""
    texts = df.select("file_id", "page_num", T.strip(F.col("text")).alias("line")).where(F.length("line") > over)
    several = texts.groupBy("file_id", "line").agg(F.countDistinct("page_num").alias("n")).where("n > 1")
    return several.groupBy("file_id").agg(F.count("*").alias("duplicates"))


def coverage(df: DataFrame, tables: DataFrame, expected: DataFrame) -> DataFrame:
    """Per file: pages expected, covered by a block or a table, missing, and the share covered, which is over 100 if
    pages beyond the expected ones are covered. expected: (file_id, expected) pages."""
    there = df.select("file_id", "page_num").unionByName(tables.select("file_id", "page_num"))
    pages = expected.join(there.groupBy("file_id").agg(F.collect_set("page_num").alias("seen")), "file_id", "left")
    pages = pages.withColumn("seen", F.coalesce("seen", F.array().cast("array<int>")))
    every = F.when(F.col("expected") > 0, F.sequence(F.lit(1), F.col("expected"))).otherwise(F.array().cast("array<int>"))
    missing = F.array_sort(F.array_except(every, F.col("seen")))
    share = F.when(F.col("expected") > 0, T.half_even(100 * F.size("seen") / F.col("expected"), 2)).otherwise(0.0)
    return pages.select("file_id", "expected", F.size("seen").alias("covered"), F.array_join(missing, ",").alias("missing_pages"), share.alias("coverage_pct"))


def missing_pages(df: DataFrame, tables: DataFrame, expected: DataFrame) -> DataFrame:
    """(file_id, page_num) of expected pages without a block or a table."""
    there = df.select("file_id", "page_num").unionByName(tables.select("file_id", "page_num")).distinct()
    every = expected.where("expected > 0").select("file_id", F.explode(F.sequence(F.lit(1), F.col("expected"))).alias("page_num"))
    return every.join(there, ["file_id", "page_num"], "left_anti")


def split_collapsed(df: DataFrame) -> DataFrame:
    """(doc_id, part, type, text): long paragraphs of several lines are split: lines that are headers, footers,
    headings or list items become rows, the others are joined as one paragraph after them. Other blocks stay as they
    are, with part -1. df: doc_id, type, text."""
    text = F.coalesce("text", F.lit(""))
    collapsed = (F.col("type") == "paragraph") & (F.length(text) > 400) & text.contains("\n")
    t = F.col("line")
    kind = (
        F.when(F.lower(t).isin(P.HEADER_PHRASES), "header").when(t.rlike(P.FOOTER_NUMBER) & (F.length(t) <= 3), "footer")
        .when(T.matches(t, P.HEADINGS), "heading").when(t.rlike(P.LIST_ITEM), "list_item")
    )
    parts = F.split(text, "\n")
    lines = df.where(collapsed).select("doc_id", F.size(parts).alias("parts"), F.posexplode(parts).alias("part", "line"))
    lines = lines.withColumn("line", T.strip(t)).where("line != ''").withColumn("type", kind)
    marked = lines.where("type is not null").select("doc_id", "part", "type", F.col("line").alias("text"))
    ordered = F.array_sort(F.collect_list(F.when(F.col("type").isNull(), F.struct("part", "line"))))
    joined = F.array_join(F.transform(ordered, lambda x: x["line"]), " ")
    body = lines.groupBy("doc_id").agg(F.max("parts").alias("part"), joined.alias("text")).where("text != ''")
    whole = df.where(~F.coalesce(collapsed, F.lit(False))).select("doc_id", F.lit(-1).alias("part"), "type", "text")
    return marked.unionByName(body.select("doc_id", "part", F.lit("paragraph").alias("type"), "text")).unionByName(whole)


def highlight(r: Column, g: Column, b: Column, white: int = 230) -> Column:
    """A callout's colour by its background, null where it is near white or none of them."""
    near_white = (r >= white) & (g >= white) & (b >= white)
    pink = (r > 200) & (b > 150) & (r - g > 20) & (b - g > 10)
    yellow = (r > 200) & (g > 180) & (b < 150) & (r - b > 60)
    blue = (b > 180) & (b - r > 30) & (b - g > 20)
    return F.when(near_white, None).when(pink, "pink_callout").when(yellow, "yellow_callout").when(blue, "blue_callout")


def background(df: DataFrame, pixels: DataFrame, sizes: DataFrame, pad: int = 6) -> DataFrame:
    """(doc_id, seq, r, g, b): the median colour, channel by channel, left of each block on its page's image: of the
    strip from 15 to 2 pixels before it, or of the first pixels inside where there is no room. Blocks of pages without
    image or size, or without pixels there, are left out. df: blocks with boxes; pixels: file_id, page_num, x, y, r, g,
    b; sizes: file_id, page_num, width, height of the page and image_width, image_height."""
    page = ["file_id", "page_num"]
    sx, sy = F.col("image_width") / F.col("width"), F.col("image_height") / F.col("height")
    boxes = df.join(sizes.where("width > 0 AND height > 0"), page).select(
        *page, "doc_id", "seq", "image_width",
        F.floor(F.least("x0", "x1") * sx).alias("px"), F.greatest(F.floor(F.col("image_height") - F.greatest("y0", "y1") * sy), F.lit(0)).alias("top"),
        F.least(F.floor(F.col("image_height") - F.least("y0", "y1") * sy), F.col("image_height")).alias("low"),
    )
    room = F.greatest(F.col("px") - 2, F.lit(0)) > F.greatest(F.col("px") - 15, F.lit(0))
    left = F.when(room, F.greatest(F.col("px") - 15, F.lit(0))).otherwise(F.col("px"))
    right = F.when(room, F.col("px") - 2).otherwise(F.least(F.col("px") + pad, F.col("image_width")))
    strips = boxes.select(*page, "doc_id", "seq", left.alias("from_x"), right.alias("to_x"), "top", "low")
    inside = strips.join(pixels, page).where("x >= from_x AND x < to_x AND y >= top AND y < low")
    return counted_medians(inside, ["doc_id", "seq"], ["r", "g", "b"])


def counted_medians(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, columns): the whole part of the median of each column of whole numbers from 0 to 255, nulls left out, by counting.

    What a task holds and hands on is a counter for each value that occurs in a group and column, 256 at most, whatever
    the number of rows; counters of tasks add up. The median is read off the running sums of a group's counters.
    """
    long = df.select(*by, F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).cast("int").alias("v")) for c in columns))).alias("x"))
    counts = long.where("x.v IS NOT NULL").groupBy(*by, "x.c", "x.v").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*by, "c")
    sums = counts.withColumns({"upto": F.sum("n").over(w.orderBy("v")), "all": F.sum("n").over(w)})
    # The middle values: those at which the running sum first reaches half of all, and half of all and one more.
    at = lambda place: F.min(F.when(F.col("upto") >= place, F.col("v")))
    low, high = at(F.floor((F.col("all") + 1) / 2)), at(F.floor(F.col("all") / 2) + 1)
    medians = sums.groupBy(*by, "c").agg(F.floor((low + high) / 2).cast("int").alias("m"))
    return medians.groupBy(*by).agg(*(F.max(F.when(F.col("c") == c, F.col("m"))).alias(c) for c in columns))


def placeholder_box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether a box is one of the whole-page boxes that stand for a missing one."""
    same = lambda b: (x0 == b[0]) & (y0 == b[1]) & (x1 == b[2]) & (y1 == b[3])
    first, second = (same(b) for b in P.FULL_PAGE_BOXES)
    return F.coalesce(first | second, F.lit(False))


def summary_like(texts: Column) -> Column:
    """Whether a model answered with a summary instead of the page: one of the texts holds a phrase of summaries, or
    there are two texts at most and one has marked-up bullet points."""
    told = F.exists(texts, lambda t: T.has_any(F.lower(t), P.SUMMARY_PHRASES))
    return told | ((F.size(texts) <= 2) & F.exists(texts, lambda t: t.rlike(P.SUMMARY_BULLETS)))


def without_tabled_blanks(df: DataFrame, tables: DataFrame) -> DataFrame:
    """df without the markers of blank pages that hold a table."""
    page = ["file_id", "page_num"]
    blank = F.coalesce(F.col("type") == "blank_page", F.lit(False))
    kept = df.where(blank).join(tables.select(*page).distinct(), page, "left_anti")
    return df.where(~blank).unionByName(kept)


def page_range(df: DataFrame, first: int = 1, last: int | None = None) -> DataFrame:
    """Blocks of the pages from first to last, both included."""
    return df.where(F.col("page_num") >= first) if last is None else df.where(F.col("page_num").between(first, last))


def page_order(df: DataFrame) -> DataFrame:
    """Adds position: blocks of a file in the order of page and block id."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy("file_id").orderBy("page_num", "block_id", "doc_id", "seq")))


def figures(images: DataFrame, least_px: int = 60, least_bytes: int = 3000) -> DataFrame:
    """Embedded images that are worth keeping: not the small pieces that maps are cut into. A side of 0 or null isn't
    known and doesn't count. images: width, height, bytes."""
    small = lambda c: F.coalesce((F.col(c) > 0) & (F.col(c) < least_px), F.lit(False))
    return images.where(~small("width") & ~small("height") & (F.col("bytes") >= least_bytes))
