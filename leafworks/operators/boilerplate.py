"""Boilerplate classes, in four passes, and the rescues that follow them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafworks.functions import patterns as P
from leafworks.functions import text as T
from leafworks.operators.blocks import PAGE_HEIGHT

#: Classes of blocks that are content all the same.
CONTENT_CLASSES = ["exercise_heading", "bibliography"]


def boilerplate_type(text: Column, top: Column | None = None, height: float = PAGE_HEIGHT) -> Column:
    """The class of a block's stripped text, null for none; the first that applies. Exercises and bibliographies
    have a class and are content all the same."""
    out = F.when(text == "", None).when(T.matches(text, P.EXERCISE), "exercise_heading").when(T.matches(text, P.BIBLIOGRAPHY), "bibliography")
    out = out.when(T.matches(text, P.FOOTER), "footer").when(T.matches(text, P.HEADER), "header")
    if top is not None:
        out = out.when((top > height * 0.93) & (F.length(text) < 80) & T.has_any(F.lower(text), P.TOP_MARGIN_WORDS), "header")
        out = out.when((top < height * 0.07) & (F.length(text) < 60), "footer")
    return out.when(T.matches(text, P.COPYRIGHT), "copyright").when(T.matches(text, P.TOC), "toc").when(T.matches(text, P.WATERMARK), "watermark")


def tag(df: DataFrame) -> DataFrame:
    """Pass one: adds line, boilerplate_type and is_boilerplate by pattern and place; exercises get their own type.
    y0 is the block's upper edge."""
    df = df.withColumn("line", T.strip(F.col("text"))).withColumn("boilerplate_type", boilerplate_type(F.col("line"), F.col("y0")))
    kept = F.col("boilerplate_type").isNull() | F.col("boilerplate_type").isin(CONTENT_CLASSES)
    kind = F.when(F.col("boilerplate_type") == "exercise_heading", "exercise_heading").otherwise(F.col("type"))
    return df.withColumns({"is_boilerplate": ~kept, "type": kind})


def with_repeats(df: DataFrame) -> DataFrame:
    """Pass two: short lines on three pages of a file are headers or footers, unless they have a class already."""
    short = (F.length("line") > 0) & (F.length("line") < 120) & F.col("file_id").isNotNull()
    # Windows and no join: blocks that lie in their file's partition already stay where they are.
    pages = F.size(F.collect_set(F.when(short, F.col("page_num"))).over(Window.partitionBy("file_id", "line")))
    df = df.withColumn("_pages", pages)
    free = F.col("boilerplate_type").isNull() & F.coalesce(short & (F.col("_pages") >= 3), F.lit(False))
    kind = F.when(free, "repeating_header_footer").otherwise(F.col("boilerplate_type"))
    return df.withColumns({"is_boilerplate": F.col("is_boilerplate") | free, "boilerplate_type": kind}).drop("_pages")


def with_types(df: DataFrame) -> DataFrame:
    """Pass three: boilerplate headers and footers have that type."""
    kind = F.when(F.col("is_boilerplate") & F.col("boilerplate_type").isin("header", "repeating_header_footer"), "header")
    kind = kind.when(F.col("is_boilerplate") & (F.col("boilerplate_type") == "footer"), "footer")
    return df.withColumn("type", kind.otherwise(F.col("type")))


def toc_pages(df: DataFrame) -> DataFrame:
    """(file_id, page_num) of pages with a long paragraph that holds three of the table-of-contents words."""
    return df.where(toc_paragraph()).select("file_id", "page_num").distinct()


def toc_paragraph() -> Column:
    low = F.lower("text")
    hits = sum(low.contains(w).cast("int") for w in P.TOC_WORDS)
    return (F.col("type") == "paragraph") & (F.length(low) > 200) & (hits >= 3)


def with_toc_numbers(df: DataFrame) -> DataFrame:
    """Pass four: boilerplate numbers on pages of a table of contents are its page numbers."""
    toc = F.bool_or(F.coalesce(toc_paragraph(), F.lit(False))).over(Window.partitionBy("file_id", "page_num"))
    df = df.withColumn("_toc", toc & F.col("file_id").isNotNull() & F.col("page_num").isNotNull())
    hit = F.col("_toc") & F.col("is_boilerplate") & F.col("line").rlike(r"^\d{1,4}$")
    kinds = {c: F.when(hit, "toc_page_number").otherwise(F.col(c)) for c in ("boilerplate_type", "type")}
    return df.withColumns(kinds).drop("_toc")


def processed(df: DataFrame) -> DataFrame:
    """All four passes over the typed blocks of whole files."""
    return with_toc_numbers(with_types(with_repeats(tag(df))))


def rescued_headings(df: DataFrame) -> DataFrame:
    """Footers that aren't boilerplate and are numbered headings become headings: sets type and was_corrected."""
    fix = ~F.col("is_boilerplate") & (F.col("type") == "footer") & F.col("line").rlike(P.NUMBERED_HEADING) & (F.length("line") < 80)
    fix = F.coalesce(fix, F.lit(False))
    before = F.col("was_corrected") if "was_corrected" in df.columns else F.lit(False)
    return df.withColumns({"type": F.when(fix, "heading").otherwise(F.col("type")), "was_corrected": fix | before})


def rescued_questions(df: DataFrame) -> DataFrame:
    """Boilerplate footers that open a question are content of type pyq_question; their class stays."""
    fix = F.coalesce(F.col("is_boilerplate") & (F.col("type") == "footer") & F.col("line").rlike(P.QUESTION_OPENERS), F.lit(False))
    before = F.col("was_corrected") if "was_corrected" in df.columns else F.lit(False)
    kind = F.when(fix, "pyq_question").otherwise(F.col("type"))
    return df.withColumns({"type": kind, "is_boilerplate": F.col("is_boilerplate") & ~fix, "was_corrected": fix | before})


def mojibake(text: Column, share: float = 0.3) -> Column:
    """Whether so many of the code points aren't printable ASCII."""
    return F.length(F.regexp_replace(text, r"[\x20-\x7E]", "")) / F.length(text) >= share


def with_encoding_errors(df: DataFrame) -> DataFrame:
    """Adds encoding_error: whether a boilerplate block's text is garbled; null for content and empty texts."""
    own = F.col("is_boilerplate") & (F.length("text") > 0)
    return df.withColumn("encoding_error", F.when(own, mojibake(F.col("text"))))
