"""Operators over blocks in order: duplicates, greedy pairs, runs, markers, reading order."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafworks.functions import patterns as P
from leafworks.functions import text as T
from leafworks.operators.blocks import boilerplate


def in_page() -> Window:
    return Window.partitionBy("file_id", "page_num").orderBy("doc_id", "seq")


def in_file() -> Window:
    return Window.partitionBy("file_id").orderBy("page_num", "doc_id", "seq")


def reindexed(df: DataFrame) -> DataFrame:
    """Adds block_id: contiguous numbers per file, in the order of its pages."""
    n = F.row_number().over(in_file())
    return df.withColumn("block_id", F.format_string("blk_%04d", n))


def consecutive_dedup(df: DataFrame) -> DataFrame:
    """Without blocks whose fingerprint is that of the block before on the same page; blank blocks have the same."""
    df = T.with_fingerprint(df, "text", "_fp")
    return df.withColumn("_before", F.lag("_fp").over(in_page())).where(~F.col("_fp").eqNullSafe(F.col("_before"))).drop("_before", "_fp")


def headings_deduped(df: DataFrame) -> DataFrame:
    """Without headings right after a heading of the same text, but for case and blanks at the ends, on their page."""
    same = F.struct(F.col("type"), F.lower(T.strip(F.col("text"))))
    df = df.withColumn("_same", same).withColumn("_before", F.lag("_same").over(in_page()))
    return df.where(~((F.col("type") == "heading") & F.col("_same").eqNullSafe(F.col("_before")))).drop("_before", "_same")


def greedy_pairs(df: DataFrame, links: Column, by: list[str], order: list[str]) -> DataFrame:
    """Adds joins (this row takes in the next one) and taken (the row before takes in this one).

    links: whether a row would join the next one. Rows are paired from the left and don't chain: of a run of links
    those at odd places join.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    df = df.withColumn("_links", F.coalesce(links, F.lit(False)))
    run = F.sum(F.when(F.col("_links"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_run", F.coalesce(run, F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*by, "_run").orderBy(*order))
    df = df.withColumn("joins", F.col("_links") & (place % 2 == 1))
    return df.withColumn("taken", F.coalesce(F.lag("joins").over(w), F.lit(False))).drop("_links", "_run")


def captions_joined(df: DataFrame) -> DataFrame:
    """Captions followed by a caption on the same page and without a final stop are joined with it."""
    by, order = ["file_id", "page_num"], ["doc_id", "seq"]
    w = Window.partitionBy(*by).orderBy(*order)
    links = (F.col("type") == "caption") & (F.lead("type").over(w) == "caption") & ~T.strip(F.col("text")).rlike(r"[.?!]$")
    out = greedy_pairs(df, links, by, order).withColumn("next_text", F.lead("text").over(w))
    text = F.when(F.col("joins"), F.concat_ws(" ", T.strip(F.col("text")), T.strip(F.col("next_text")))).otherwise(F.col("text"))
    return out.withColumn("text", text).where(~F.col("taken")).drop("joins", "taken", "next_text")


def sentences_merged(df: DataFrame) -> DataFrame:
    """Content paragraphs without a final mark are joined with the next block that isn't boilerplate, if that is a
    paragraph on the next page which doesn't start with a capital: sets text and was_corrected.

    Looking past boilerplate is looking at the blocks without it; boilerplate stays where it is.
    """
    by, order = ["file_id", "_bad"], ["page_num", "doc_id", "seq"]
    before = F.col("was_corrected") if "was_corrected" in df.columns else F.lit(False)
    # Boilerplate is a partition of its own, in which nothing is joined: one window, and no second reading of df.
    df = df.withColumns({"was_corrected": before, "_bad": boilerplate(df)})
    w = Window.partitionBy(*by).orderBy(*order)
    text, after = F.regexp_replace("text", r"(?U)\s+$", ""), F.regexp_replace(F.lead("text").over(w), r"(?U)^\s+", "")
    next_page = (F.lead("type").over(w) == "paragraph") & (F.lead("page_num").over(w) == F.col("page_num") + 1)
    links = ~F.col("_bad") & (F.col("type") == "paragraph") & next_page & (text != "") & ~text.rlike(P.SENTENCE_END) & (after != "") & ~after.rlike("^[A-Z‘“]")
    out = greedy_pairs(df, links, by, order).withColumn("_next", F.lead("text").over(w))
    merged = F.concat_ws(" ", text, F.regexp_replace("_next", r"(?U)^\s+", ""))
    out = out.withColumns({"text": F.when(F.col("joins"), merged).otherwise(F.col("text")), "was_corrected": F.col("was_corrected") | F.col("joins")})
    return out.where(~F.col("taken")).drop("joins", "taken", "_next", "_bad")


def unmerged_splits(df: DataFrame) -> DataFrame:
    """(file_id, unmerged): pairs of neighbouring content paragraphs of a file, over pages too, where a sentence seems
    to go on."""
    w = in_file()
    text, own = T.strip(F.col("text")), (F.col("type") == "paragraph") & ~boilerplate(df)
    df = df.withColumns({"_t": text, "_own": F.coalesce(own, F.lit(False))})
    split = F.col("_own") & F.lead("_own").over(w) & (F.col("_t") != "") & ~F.col("_t").rlike(P.SPLIT_END) & F.lead("_t").over(w).rlike("^[a-z]")
    return df.withColumn("split", split).groupBy("file_id").agg(F.count_if("split").alias("unmerged"))


def colour_runs(df: DataFrame, colour: Column) -> DataFrame:
    """Adds box_id: runs of one colour on a page share one; blocks without a colour have none and end a run."""
    w = in_page()
    df = df.withColumn("highlight_type", colour)
    start = F.col("highlight_type").isNotNull() & ~F.col("highlight_type").eqNullSafe(F.lag("highlight_type").over(w))
    n = F.sum(start.cast("int")).over(w)
    df = df.withColumn("_n", n)
    return df.withColumn("box_id", F.when(F.col("highlight_type").isNotNull(), F.format_string("box_p%d_%03d", "page_num", "_n"))).drop("_n")


def page_empty(df: DataFrame) -> Column:
    """Whether a block leaves its page blank."""
    return boilerplate(df) | F.coalesce(F.col("type").isin("header", "footer", "toc_page_number"), F.lit(False))


def blank_markers(df: DataFrame) -> DataFrame:
    """(file_id, page_num, type, text): a marker for each page whose blocks are all boilerplate, headers, footers or
    page numbers of a table of contents."""
    pages = df.groupBy("file_id", "page_num").agg(F.bool_and(page_empty(df)).alias("blank"))
    return pages.where("blank").select("file_id", "page_num", F.lit("blank_page").alias("type"), F.lit("").alias("text"))


def with_blank_markers(df: DataFrame) -> DataFrame:
    """df with a marker for each page of blank_markers(), and position: the place in the file, blocks in their order and a
    page's marker after its blocks. Markers aren't boilerplate and have no other columns than file, page, type and text."""
    page = Window.partitionBy("file_id", "page_num")
    last = F.row_number().over(page.orderBy(F.desc("doc_id"), F.desc("seq"))) == 1
    df = df.withColumns({"_blank": F.bool_and(page_empty(df)).over(page) & last})
    # A blank page's last block gives two rows, itself and the marker: df is read once and moves once.
    both = df.withColumn("_marker", F.explode(F.when(F.col("_blank"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    marked = {"type": F.lit("blank_page"), "text": F.lit(""), "is_boilerplate": F.lit(False)}
    marker = F.col("_marker") == 1
    own = {c: F.when(~marker, F.col(c)) for c in df.columns if c not in ("file_id", "page_num", "_blank")}
    own |= {c: F.when(marker, v).otherwise(F.col(c)) if c in df.columns else F.when(marker, v) for c, v in marked.items()}
    w = Window.partitionBy("file_id").orderBy("page_num", "_marker", "doc_id", "seq")
    return both.withColumns(own).drop("_blank").withColumn("position", F.row_number().over(w)).drop("_marker")


def page_extents(df: DataFrame, least: int = 100) -> DataFrame:
    """(file_id, page_num, min_x, max_x, width): from the leftmost to the rightmost edge of a page's boxes."""
    page = df.groupBy("file_id", "page_num").agg(F.min("x0").alias("min_x"), F.max("x1").alias("max_x"))
    return page.withColumn("width", F.greatest(F.col("max_x") - F.col("min_x"), F.lit(least)))


def reading_order(df: DataFrame, band: int = 6, least: int = 100) -> DataFrame:
    """Adds position within the page: pages of two columns go headers, left, right, footers; others by bands of y,
    then x; blocks without a box come last. A page has two columns if four narrow blocks or more lie on each side of
    its middle and they are over 60 % of its boxes; its width is that of its blocks."""
    page = Window.partitionBy("file_id", "page_num")
    boxed = F.col("x0").isNotNull() & F.col("y0").isNotNull() & F.col("x1").isNotNull() & F.col("y1").isNotNull()
    low, high = F.min(F.when(boxed, F.col("x0"))).over(page), F.max(F.when(boxed, F.col("x1"))).over(page)
    df = df.withColumns({"_boxed": boxed, "_low": low, "_width": F.greatest(high - low, F.lit(least))})
    left = (F.col("x0") + F.col("x1")) / 2 < F.col("_low") + F.col("_width") / 2
    narrow = F.col("_boxed") & ((F.col("x1") - F.col("x0")) / F.col("_width") < 0.5)
    sums = {"_l": F.count_if(narrow & left), "_r": F.count_if(narrow & ~left), "_s": F.count_if(narrow), "_n": F.count_if("_boxed")}
    df = df.withColumns({k: v.over(page) for k, v in sums.items()})
    columns = (F.col("_l") >= 4) & (F.col("_r") >= 4) & (F.col("_s") > 0.6 * F.col("_n"))
    zone = F.when(~F.col("_boxed"), 9).when(~columns, 0).when(F.col("type") == "header", 0).when(F.col("type") == "footer", 3).when(left, 1).otherwise(2)
    df = df.withColumn("_zone", zone)
    y, x = (F.when(F.col("_boxed"), c) for c in (-F.bround(F.col("y0") / band) * band, F.col("x0")))
    rank = F.row_number().over(page.orderBy("_zone", y, x, "doc_id", "seq"))
    return df.withColumn("position", rank).drop("_l", "_r", "_s", "_n", "_zone", "_boxed", "_low", "_width")


def with_width(df: DataFrame, widths: DataFrame | None, width: float = 612) -> DataFrame:
    """Adds _width: the page's, or the default for pages that widths (file_id, page_num, page_width) doesn't have."""
    if widths is None:
        return df.withColumn("_width", F.lit(float(width)))
    found = df.join(widths.select("file_id", "page_num", F.col("page_width").alias("_width")), ["file_id", "page_num"], "left")
    return found.withColumn("_width", F.coalesce("_width", F.lit(float(width))))


def column_midpoint(df: DataFrame, widths: DataFrame | None = None, width: float = 612) -> DataFrame:
    """(file_id, page_num, mid): the middle of the widest gap between the left edges of narrow blocks, if there are
    four edges or more and it lies between 30 and 70 % of the page; else half the width."""
    df = with_width(df, widths, width)
    edges = df.where(F.col("x1") - F.col("x0") <= 0.7 * F.col("_width")).select("file_id", "page_num", "_width", F.round("x0", 1).alias("x0")).distinct()
    w = Window.partitionBy("file_id", "page_num").orderBy("x0")
    gaps = edges.withColumns({"next": F.lead("x0").over(w), "n": F.count("*").over(Window.partitionBy("file_id", "page_num"))})
    mid, gap = (F.col("x0") + F.col("next")) / 2, F.col("next") - F.col("x0")
    good = (F.col("n") >= 4) & (gap >= 15) & (mid >= 0.3 * F.col("_width")) & (mid <= 0.7 * F.col("_width"))
    best = gaps.groupBy("file_id", "page_num").agg(F.max_by(F.when(good, mid), F.when(good, F.struct(gap, -F.col("x0")))).alias("found"))
    pages = df.groupBy("file_id", "page_num").agg(F.max("_width").alias("_width"))
    return pages.join(best, ["file_id", "page_num"], "left").select("file_id", "page_num", F.coalesce("found", F.col("_width") / 2).alias("mid"))


def page_reorder(df: DataFrame, widths: DataFrame | None = None, width: float = 612, margin: int = 5) -> DataFrame:
    """Adds position: from the top; blocks of full width cut the page in segments, each left column, then right, on
    either side of the column's middle. Blocks without a box are at the foot of the left column."""
    page = Window.partitionBy("file_id", "page_num")
    df = with_width(df, widths, width).join(column_midpoint(df, widths, width), ["file_id", "page_num"])
    boxed = F.col("x0").isNotNull() & F.col("x1").isNotNull() & F.col("y0").isNotNull() & F.col("y1").isNotNull()
    top = F.when(boxed, F.col("y0")).otherwise(0)
    df = df.withColumns({"_top": top, "_a": F.coalesce(boxed & ((F.col("x1") - F.col("x0")) > 0.7 * F.col("_width")), F.lit(False))})
    down = [F.desc("_top"), F.asc("doc_id"), F.asc("seq")]
    df = df.withColumn("_seg", F.sum(F.col("_a").cast("int")).over(page.orderBy(*down).rowsBetween(Window.unboundedPreceding, 0)))
    side = F.when(F.col("_a"), -1).when(~boxed | (F.col("x0") < F.col("mid") - margin), 0).otherwise(1)
    ranked = df.withColumn("_side", side).withColumn("position", F.row_number().over(page.orderBy("_seg", "_side", *down)))
    return ranked.drop("_a", "_seg", "_side", "_top", "_width", "mid")


def page_dedup(pages: DataFrame, topic_words: list[str], back: int = 4, shortest: int = 60) -> DataFrame:
    """(file_id, page_num, text) without pages that repeat one of the `back` pages before them: word sets alike to
    0.8, or to 0.5 where the page holds a topic word. Short pages are not compared."""
    # A file's pages move once; what a page is compared with comes from the rows before it.
    low = pages.repartition("file_id").withColumn("_low", T.normalized(F.col("text")))
    low = low.withColumn("_words", F.when(F.length("_low") >= shortest, F.array_distinct(F.split("_low", " "))))
    w = Window.partitionBy("file_id").orderBy("page_num")
    topic = T.has_any(F.col("_low"), topic_words)
    alike = lambda other: F.size(F.array_intersect("_words", other)) / F.size(F.array_union("_words", other))
    near = lambda other: T.named(alike(other), lambda x: (x >= 0.8) | ((x >= 0.5) & F.col("_topic")))
    low = low.withColumns({"_topic": topic} | {f"_b{k}": F.lag("_words", k).over(w) for k in range(1, back + 1)})
    both = lambda k: F.col("_words").isNotNull() & F.col(f"_b{k}").isNotNull()
    gone = reduce(or_, [F.when(both(k), near(F.col(f"_b{k}"))).otherwise(F.lit(False)) for k in range(1, back + 1)])
    known = F.col("file_id").isNotNull() & F.col("page_num").isNotNull()
    low = low.select(*pages.columns, (F.coalesce(gone, F.lit(False)) & known).alias("_gone"))
    return low.withColumn("_gone", F.bool_or("_gone").over(Window.partitionBy("file_id", "page_num"))).where("NOT _gone").drop("_gone")


def white_rects(rects: DataFrame, sizes: DataFrame, width: float = 612, height: float = 842) -> DataFrame:
    """The rectangles that may hide text: nearly white in each channel and smaller than a twentieth of their page.
    rects: file_id, page_num, rx0, ry0, rx1, ry1, r, g, b (0 to 1, null: no fill); sizes: file_id, page_num, width, height."""
    area = F.abs((F.col("rx1") - F.col("rx0")) * (F.col("ry1") - F.col("ry0")))
    page = F.coalesce("width", F.lit(float(width))) * F.coalesce("height", F.lit(float(height)))
    white = (F.col("r") > 0.9) & (F.col("g") > 0.9) & (F.col("b") > 0.9)
    return rects.join(sizes, ["file_id", "page_num"], "left").where(white & (area < 0.05 * page)).select(rects.columns)


def gridded(df: DataFrame, box: tuple[str, str, str, str], cell: int) -> DataFrame:
    """A row for each cell of a square grid that the box touches: adds _cx, _cy."""
    at = lambda c: F.floor(F.col(c) / cell)
    columns = df.withColumn("_cx", F.explode(F.sequence(at(box[0]), at(box[2]))))
    return columns.withColumn("_cy", F.explode(F.sequence(at(box[1]), at(box[3]))))


def overlaps(df: DataFrame, rects: DataFrame, key: list[str], cell: int = 72) -> DataFrame:
    """(key, area, shared): for each block and rectangle of one page that overlap, the block's area and what they share.

    The join's key is a cell of the page's grid, so that a page of many blocks and rectangles isn't one key. A pair that
    meets in several cells counts in one: the one that holds the lower left corner of what they share.
    """
    page = ["file_id", "page_num"]
    own = df.where("x1 > x0 AND y1 > y0").select(*page, *key, "x0", "y0", "x1", "y1")
    other = rects.where("rx1 > rx0 AND ry1 > ry0").select(*page, "rx0", "ry0", "rx1", "ry1")
    pairs = gridded(own, ("x0", "y0", "x1", "y1"), cell).join(gridded(other, ("rx0", "ry0", "rx1", "ry1"), cell), [*page, "_cx", "_cy"])
    left, low = F.greatest("x0", "rx0"), F.greatest("y0", "ry0")
    width, height = F.least("x1", "rx1") - left, F.least("y1", "ry1") - low
    owner = (F.floor(left / cell) == F.col("_cx")) & (F.floor(low / cell) == F.col("_cy"))
    return pairs.where((width > 0) & (height > 0) & owner).select(*key, ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"), (width * height).alias("shared"))


def covered(df: DataFrame, rects: DataFrame, share: float = 0.85, key: tuple[str, ...] = ("doc_id", "seq")) -> DataFrame:
    """df without blocks that one rectangle of their page covers by more than the share of their area; blocks without
    a box, or an area, stay. key: what names a block."""
    gone = overlaps(df, rects, [*key]).where(F.col("shared") > share * F.col("area")).select(*key).distinct()
    return df.join(gone, [*key], "left_anti")


def line_zones(lines: DataFrame) -> DataFrame:
    """Adds zone (header, left, right, footer), kind (header, footer, heading, list_item or null for plain lines) and
    place (the order in the page) to recognised lines: file_id, page_num, line_no, text, xc, yc, width, height."""
    t = T.strip(F.col("text"))
    head = (F.col("yc") < 0.08 * F.col("height")) | F.lower(t).isin(P.HEADER_PHRASES)
    foot = (F.col("yc") > 0.92 * F.col("height")) | (t.rlike(P.FOOTER_NUMBER) & (F.length(t) <= 3))
    zone = F.when(head, "header").when(foot, "footer").when(F.col("xc") < F.col("width") / 2, "left").otherwise("right")
    df = lines.where(t != "").withColumns({"text": t, "zone": zone})
    body = F.when(T.matches(t, P.LINE_HEADINGS), "heading").when(t.rlike(P.LIST_ITEM), "list_item")
    kind = F.when(F.col("zone").isin("header", "footer"), F.col("zone")).otherwise(body)
    rank = F.when(F.col("zone") == "header", 0).when(F.col("zone") == "left", 1).when(F.col("zone") == "right", 2).otherwise(3)
    df = df.withColumns({"kind": kind, "_rank": rank, "_y": F.when(F.col("zone").isin("left", "right"), F.col("yc"))})
    place = F.row_number().over(Window.partitionBy("file_id", "page_num").orderBy("_rank", "_y", "line_no"))
    return df.withColumn("place", place).drop("_rank", "_y")


def islands(df: DataFrame, by: list[str], order: str, new: Column) -> DataFrame:
    """(by, place, type, text): runs of plain lines (kind null) joined as paragraphs, broken by lines of a kind and
    where new is true; place numbers the blocks."""
    w = Window.partitionBy(*by).orderBy(order)
    starts = F.col("kind").isNotNull() | F.lag("kind").over(w).isNotNull() | F.lag(order).over(w).isNull() | F.coalesce(new, F.lit(False))
    df = df.withColumn("_new", starts).withColumn("_n", F.sum(F.col("_new").cast("int")).over(w))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "text"))), lambda x: x["text"])
    found = df.groupBy(*by, F.col("_n").alias("place")).agg(F.coalesce(F.max("kind"), F.lit("paragraph")).alias("type"), F.array_join(ordered, " ").alias("text"))
    return found.select(*by, F.col("place").cast("int").alias("place"), "type", "text")


def zoned_blocks(lines: DataFrame) -> DataFrame:
    """(file_id, page_num, place, type, text): the blocks of pages of recognised lines, headers first, then the left
    and the right column, then footers."""
    return islands(line_zones(lines), ["file_id", "page_num"], "place", F.lit(False))


def column_blocks(lines: DataFrame) -> DataFrame:
    """(file_id, page_num, column, place, type, text): the blocks of columns of lines by their geometry. A paragraph
    ends at a wide gap, at an indented line, or at a smaller gap where a sentence ends and a capital follows.
    lines: file_id, page_num, column, line_no, text, min_x, min_y, max_y (low y is the top)."""
    by = ["file_id", "page_num", "column"]
    w = Window.partitionBy(*by).orderBy("line_no")
    t = F.col("text")
    df = lines.withColumn("kind", F.when(T.matches(t, P.HEADINGS), "heading").when(t.rlike(P.LIST_ITEM), "list_item"))
    high = F.greatest(F.lag("max_y").over(w) - F.lag("min_y").over(w), F.lit(10.0))
    gap = F.col("min_y") - F.lag("max_y").over(w)
    ends = F.lag("text").over(w).rlike(P.LINE_END) & t.rlike("^[A-Z\"’]") & (gap > 0.5 * high)
    return islands(df, by, "line_no", (gap > 1.35 * high) | (F.col("min_x") > F.lag("min_x").over(w) + 14) | ends)
