"""Operators over tables: rows as arrays of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafworks.functions import patterns as P
from leafworks.functions import text as T


def from_lines(df: DataFrame) -> DataFrame:
    """(file_id, page_num, doc_id, headers, rows) from lines with cells between ` | `: the first line is the header."""
    lines = df.where(F.col("text").contains(" | ")).select("file_id", "page_num", "doc_id", "seq", F.split("text", r" \| ").alias("cells"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("seq", "cells"))), lambda x: x["cells"])
    grouped = lines.groupBy("file_id", "page_num", "doc_id").agg(ordered.alias("all"))
    return grouped.select("file_id", "page_num", "doc_id", F.get("all", F.lit(0)).alias("headers"), rest_of(F.col("all")).alias("rows"))


def rest_of(cells: Column) -> Column:
    """An array without its first element."""
    return F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0)))


def filled(cells: Column) -> Column:
    return F.filter(F.transform(cells, lambda c: T.strip(c)), lambda c: c != "")


def row_text(cells: Column) -> Column:
    return F.array_join(filled(cells), " ")


def numbered(tables: DataFrame) -> DataFrame:
    """Adds table_id, by page and document in each file, and the counts of rows and columns."""
    n = F.row_number().over(Window.partitionBy("file_id").orderBy("page_num", "doc_id"))
    return tables.withColumns({"table_id": F.format_string("tbl_%03d", n), "row_count": F.size("rows"), "column_count": F.size("headers")})


def toc_like(rows: Column) -> Column:
    """Whether over half of the rows have dot leaders, or over 40 % repeat a cell."""
    dots = F.size(F.filter(rows, lambda r: F.array_join(r, " ").rlike(P.DOT_LEADER)))
    repeats = F.size(F.filter(rows, lambda r: F.size(F.array_distinct(filled(r))) < F.size(filled(r))))
    return (F.size(rows) > 0) & ((2 * dots > F.size(rows)) | (10 * repeats > 4 * F.size(rows)))


def degenerate(headers: Column, rows: Column) -> Column:
    """Why a table is no table: empty, single_cell, generic_headers, sparse_rows; null if it is one."""
    sparse = F.size(F.filter(rows, lambda r: F.size(filled(r)) <= 1))
    return (
        F.when((F.size(rows) == 0) | (F.size(headers) == 0), "empty").when((F.size(rows) <= 1) & (F.size(headers) <= 1), "single_cell")
        .when(F.forall(headers, lambda h: F.lower(T.strip(h)).isin(P.GENERIC_HEADERS)), "generic_headers")
        .when(10 * sparse > 4 * F.size(rows), "sparse_rows")
    )


def without_placeholders(df: DataFrame) -> DataFrame:
    """Headers that hold a comment's beginning become Col_n, cells that do are emptied."""
    headers = F.transform("headers", lambda h, i: F.when(h.contains("<!--"), F.concat(F.lit("Col_"), (i + 1).cast("string"))).otherwise(h))
    rows = F.transform("rows", lambda r: F.transform(r, lambda c: F.when(c.contains("<!--"), "").otherwise(c)))
    return df.withColumns({"headers": headers, "rows": rows})


def clean_headers(headers: Column) -> Column:
    """All-digit headers: two become a named pair, others Column_n with the next number."""
    digits = F.forall(headers, lambda h: h.rlike(r"^\d+$")) & (F.size(headers) > 0)
    number = F.transform(headers, lambda h: F.concat(F.lit("Column_"), (h.cast("decimal(38,0)") + 1).cast("string")))
    pair = F.array(F.lit("Section / Unit"), F.lit("Page Number"))
    return F.when(digits & (F.size(headers) == 2), pair).when(digits, number).otherwise(headers)


def without_phantom(df: DataFrame) -> DataFrame:
    """Without the first column of tables where each filled cell of it is boilerplate; rows of one cell go with it."""
    first = lambda r: T.strip(F.coalesce(F.get(r, F.lit(0)), F.lit("")))
    phantom = F.forall("rows", lambda r: (first(r) == "") | T.matches(first(r), P.TABLE_BOILERPLATE)) & (F.size("rows") > 0) & (F.size("headers") > 0)
    rest = F.transform(F.filter("rows", lambda r: F.size(r) > 1), rest_of)
    return df.withColumns({"headers": F.when(phantom, rest_of(F.col("headers"))).otherwise(F.col("headers")), "rows": F.when(phantom, rest).otherwise(F.col("rows"))})


def citations_moved(df: DataFrame) -> DataFrame:
    """Rows that are citations leave the table and become its caption, or follow the caption in brackets."""
    before = F.coalesce(F.col("caption"), F.lit("")) if "caption" in df.columns else F.lit("")
    cited = F.transform(F.filter("rows", lambda r: row_text(r).rlike(P.CITATION_ROW)), row_text)
    caption = F.aggregate(cited, before, lambda a, x: F.when(a == "", x).otherwise(F.concat(a, F.lit(" ("), x, F.lit(")"))))
    return df.withColumns({"caption": caption, "rows": F.filter("rows", lambda r: ~row_text(r).rlike(P.CITATION_ROW))})


def repaired(df: DataFrame) -> DataFrame:
    """Placeholders, headers, phantom columns and citations put right, in this order."""
    df = without_placeholders(df)
    return citations_moved(without_phantom(df.withColumn("headers", clean_headers(F.col("headers")))))


def fate(headers: Column, rows: Column) -> Column:
    """What becomes of a table: toc (a table of contents), empty and single_cell are dropped, generic_headers and
    sparse_rows are to be reviewed, null is a table."""
    return F.when(toc_like(rows), "toc").otherwise(degenerate(headers, rows))


def kept(tables: DataFrame) -> DataFrame:
    """The tables that stay, with needs_review."""
    found = tables.withColumn("_fate", fate(F.col("headers"), F.col("rows")))
    review = F.coalesce(F.col("_fate").isin("generic_headers", "sparse_rows"), F.lit(False))
    return found.where(F.col("_fate").isNull() | review).withColumn("needs_review", review).drop("_fate")


def rescued_rows(tables: DataFrame, df: DataFrame) -> DataFrame:
    """(file_id, page_num, type, text, is_boilerplate, boilerplate_type, was_corrected) of the rows of dropped tables
    whose text is no block of the file yet: toc blocks of tables of contents, list items of the others. Of rows that
    are alike the first stays, those of tables of contents before the others."""
    dropped = tables.withColumn("_fate", fate(F.col("headers"), F.col("rows"))).where(F.col("_fate").isin("toc", "empty", "single_cell"))
    toc = F.col("_fate") == "toc"
    rows = dropped.select("file_id", "page_num", "doc_id", toc.alias("toc"), F.posexplode("rows").alias("row", "cells"))
    texts = rows.withColumn("text", row_text(F.col("cells"))).where("text != ''").withColumn("norm", T.normalized(F.col("text")))
    there = df.select("file_id", T.normalized(F.col("text")).alias("norm")).distinct()
    first = F.min(F.struct((~F.col("toc")).alias("later"), "page_num", "doc_id", "row", "text")).alias("x")
    new = texts.join(there, ["file_id", "norm"], "left_anti").groupBy("file_id", "norm").agg(first)
    kind = F.when(F.col("x.later"), "list_item").otherwise("toc")
    return new.select(
        "file_id", "x.page_num", kind.alias("type"), "x.text", (~F.col("x.later")).alias("is_boilerplate"),
        F.when(~F.col("x.later"), "toc").alias("boilerplate_type"), F.col("x.later").alias("was_corrected"),
    )
