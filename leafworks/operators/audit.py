"""Audits: rules, issues, confidence and ratings of extracted files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafworks.functions import patterns as P
from leafworks.functions import text as T
from leafworks.operators import blocks as B
from leafworks.operators import sequences
from leafworks.operators.registry import numbered
from leafworks.sources.store import written

RATINGS = ["Excellent", "Good", "Fair", "Poor"]
RULES = ["valid_json", "has_metadata", "has_blocks", "pages_valid", "types_valid", "texts_filled", "tagged", "tables_valid", "has_entities"]


def rules(files: DataFrame, df: DataFrame, tables: DataFrame) -> DataFrame:
    """Per file: the nine rules as booleans and how many hold. A broken file keeps none, a file without blocks only
    the first two at most.

    files: file_id, corrupt, file_name, extracted_at. df: file_id, page_num, type, text, is_boilerplate, entities
    (null where missing). tables: file_id, table_id, rows.
    """
    every = lambda c: F.coalesce(F.bool_and(F.coalesce(c, F.lit(False))), F.lit(False))
    found = df.groupBy("file_id").agg(
        (F.count("*") > 0).alias("has_blocks"), every(F.col("page_num") >= 1).alias("pages_valid"),
        every(F.col("type").isin(P.BLOCK_TYPES)).alias("types_valid"),
        every((F.col("type") == "blank_page") | (T.strip(F.col("text")) != "")).alias("texts_filled"),
        every(F.col("is_boilerplate").isNotNull()).alias("tagged"), every(F.col("entities").isNotNull()).alias("has_entities"),
    )
    shaped = tables.groupBy("file_id").agg(every(F.col("table_id").isNotNull() & F.col("rows").isNotNull()).alias("tables_valid"))
    out = files.join(found, "file_id", "left").join(shaped, "file_id", "left")
    valid = ~F.coalesce(F.col("corrupt"), F.lit(False))
    named = (F.coalesce("file_name", F.lit("")) != "") & (F.coalesce("extracted_at", F.lit("")) != "")
    there = valid & F.coalesce("has_blocks", F.lit(False))
    marks = {"valid_json": valid, "has_metadata": valid & named, "has_blocks": there, "tables_valid": there & F.coalesce("tables_valid", F.lit(True))}
    marks |= {n: there & F.coalesce(n, F.lit(False)) for n in RULES if n not in marks}
    out = out.select("file_id", *(marks[n].alias(n) for n in RULES))
    return out.withColumn("passed", sum(F.col(n).cast("int") for n in RULES))


def confidence(coverage: Column, passed: Column, high: Column, medium: Column, low: Column, of: int = 9) -> Column:
    """The score from 0 to 100: points are lost for missing pages, broken rules and issues by severity."""
    score = 100 - 0.3 * (100 - coverage) - 2.2 * (of - passed) - 15 * high - 5 * medium - 2 * low
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), T.half_even(score, 1)))


def rating(score: Column) -> Column:
    return F.when(score >= 90, "Excellent").when(score >= 75, "Good").when(score >= 55, "Fair").otherwise("Poor")


def ocr_residue(text: Column) -> Column:
    """Whether a text holds words that recognition broke."""
    return text.contains(P.OCR_WORD) | text.rlike(P.OCR_RESIDUE)


def evaluated(files: DataFrame, df: DataFrame, tables: DataFrame) -> DataFrame:
    """Per file: block counts, the nine rules, page coverage, the issues of eight dimensions, score, rating and
    whether it is ready. A file without output (there is false) has one issue, score 0 and is Poor.

    files: file_id, there, expected (pages), corrupt, file_name, extracted_at. df: blocks with boxes, type,
    is_boilerplate, was_corrected, entities. tables: file_id, page_num, table_id, rows.
    """
    df, tables = written(df), written(tables)  # six questions are asked of them: what they come from runs once
    found = files.where("there")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    bad, text = F.coalesce("is_boilerplate", F.lit(False)), F.coalesce("text", F.lit(""))
    counts = df.groupBy("file_id").agg(
        F.count("*").alias("total_blocks"), F.count_if(~bad).alias("content_blocks"), F.count_if(bad).alias("boilerplate_blocks"),
        F.count_if(F.coalesce("was_corrected", F.lit(False))).alias("corrected_blocks"),
        F.sum(F.coalesce(F.size("entities"), F.lit(0))).alias("entity_count"), F.count_if(ocr_residue(text)).alias("ocr_errors"),
        F.count_if(B.placeholder_box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).alias("placeholder_boxes"),
    )
    tabled = tables.groupBy("file_id").agg(F.count("*").alias("table_count"))
    out = found.select("file_id", "expected")
    for part in (
        counts, tabled, rules(found.select("file_id", "corrupt", "file_name", "extracted_at"), df, tables).select("file_id", "passed"),
        B.coverage(df, tables, found.select("file_id", "expected")).select("file_id", "missing_pages", "coverage_pct"),
        B.contamination(df), sequences.unmerged_splits(df),
    ):
        out = out.join(part, "file_id", "left")
    names = ["total_blocks", "content_blocks", "boilerplate_blocks", "corrected_blocks", "entity_count", "table_count", "ocr_errors", "placeholder_boxes", "duplicates", "unmerged"]
    out = out.withColumns({n: zero(n) for n in names})
    issue = lambda c: c.cast("int")
    high = issue(F.col("missing_pages") != "") + issue((F.col("content_blocks") == 0) & (F.col("expected") > 0))
    medium = issue(F.col("ocr_errors") > 0) + issue(F.col("duplicates") > 0)
    low = issue(F.col("unmerged") > 0) + issue(F.col("placeholder_boxes") > 0)
    named = {
        "Completeness (High)": F.col("missing_pages") != "", "Continuity (Low)": F.col("unmerged") > 0, "OCR Errors (Medium)": F.col("ocr_errors") > 0,
        "Duplicate Content (Medium)": F.col("duplicates") > 0, "Data Integrity (Low)": F.col("placeholder_boxes") > 0,
        "Readability (High)": (F.col("content_blocks") == 0) & (F.col("expected") > 0),
    }
    issues = F.concat_ws(", ", *(F.when(c, n) for n, c in named.items()))
    out = out.withColumns({"high": high, "medium": medium, "low": low, "issues": issues})
    out = out.withColumn("score", confidence(F.col("coverage_pct"), F.col("passed"), F.col("high"), F.col("medium"), F.col("low")))
    out = out.drop("expected", "missing_pages")
    lost = files.where("NOT there").select("file_id")
    kinds = dict(out.dtypes)
    empty = {"high": 1, "issues": "Completeness (High)"}
    lost = lost.select("file_id", *(F.lit(empty.get(n, 0)).cast(kinds[n]).alias(n) for n in out.columns if n != "file_id"))
    both = out.unionByName(lost).withColumn("rating", rating(F.col("score")))
    return both.withColumn("ready", F.col("rating").isin("Excellent", "Good"))


def ratings(found: DataFrame, by: Column) -> DataFrame:
    """Counts by rating, mean score and coverage, sums and readiness per folder, with a TOTAL row. by: a file's folder."""
    rolled = found.withColumn("folder", by).rollup("folder").agg(
        F.count("*").alias("documents"), *(F.count_if(F.col("rating") == r).alias(r.lower()) for r in RATINGS),
        F.count_if("ready").alias("ready"), T.half_even(F.avg(F.col("score").cast("decimal(12,1)")), 1).alias("mean_score"),
        T.half_even(F.avg(F.col("coverage_pct").cast("decimal(12,2)")), 1).alias("mean_coverage"),
        *(F.sum(n).alias(n) for n in ("total_blocks", "content_blocks", "corrected_blocks", "entity_count")), F.grouping("folder").alias("g"),
    )
    return rolled.withColumn("folder", F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("folder"))).drop("g")


def report(found: DataFrame) -> DataFrame:
    """(file_id, line): a Markdown table row for each file of evaluated()."""
    cells = F.concat_ws(" | ", "file_id", F.col("score").cast("string"), "rating", F.col("coverage_pct").cast("string"), F.when(F.col("ready"), "yes").otherwise("no"))
    return found.select("file_id", F.concat(F.lit("| "), cells, F.lit(" |")).alias("line"))


def sections(found: DataFrame) -> DataFrame:
    """(part, place, line): the report on a corpus, from evaluated(): a summary, the ratings with their shares, the issues
    by dimension and severity with the files that have them, and a numbered table row for each file."""
    percent = lambda a, b: T.half_even(100 * a / F.greatest(b, F.lit(1)), 1).cast("string")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    mean = lambda c, kind: T.half_even(F.coalesce(F.avg(F.col(c).cast(kind)), F.lit(0)), 1)
    sums = found.agg(
        F.count("*").alias("n"), F.count_if("ready").alias("ready"), mean("score", "decimal(12,1)").alias("score"), mean("coverage_pct", "decimal(12,2)").alias("coverage"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_blocks", "content_blocks", "corrected_blocks", "entity_count")),
        *(F.count_if(F.col("rating") == r).alias(r) for r in RATINGS),
    )
    n = F.col("n")
    lines = [
        text("Files: ", n), text("Mean confidence: ", F.col("score"), "%"), text("Mean coverage: ", F.col("coverage"), "%"),
        text("Ready: ", F.col("ready"), " of ", n, " (", percent(F.col("ready"), n), "%)"),
        text("Blocks: ", F.col("total_blocks"), ", content: ", F.col("content_blocks"), ", corrected: ", F.col("corrected_blocks")), text("Entities: ", F.col("entity_count")),
    ]
    shares = [text(f"| {r} | ", F.col(r), " | ", percent(F.col(r), n), "% |") for r in RATINGS]
    out = [sums.select(F.lit(part).alias("part"), F.posexplode(F.array(*x)).alias("place", "line")) for part, x in ((1, lines), (2, shares))]
    issues = found.select(F.explode(F.split("issues", ", ")).alias("issue")).where("issue <> ''").groupBy("issue").agg(F.count("*").alias("files"))
    place = F.row_number().over(Window.orderBy("issue"))  # six kinds at most
    out.append(issues.select(F.lit(3).alias("part"), (place - 1).alias("place"), text("| ", F.col("issue"), " | ", F.col("files"), " |").alias("line")))
    rows = numbered(found, "file_id", into="place")
    cells = F.concat_ws(" | ", F.col("place").cast("string"), "file_id", F.concat(F.col("coverage_pct").cast("string"), F.lit("%")), F.concat(F.col("passed").cast("string"), F.lit("/9")),
                        F.concat(F.col("score").cast("string"), F.lit("%")), "rating", F.when(F.col("ready"), "yes").otherwise("no"))
    out.append(rows.select(F.lit(4).alias("part"), (F.col("place") - 1).alias("place"), F.concat(F.lit("| "), cells, F.lit(" |")).alias("line")))
    return reduce(DataFrame.unionByName, (x.withColumn("place", F.col("place").cast("long")) for x in out))


def write_report(found: DataFrame, path: str) -> None:
    """Writes sections() as Markdown lines in text files whose names are in the report's order."""
    heads = {1: "# Summary", 2: "# Ratings", 3: "# Issues", 4: "# Files"}
    title = F.create_map(*(F.lit(x) for kv in heads.items() for x in kv))
    titled = found.unionByName(found.select("part").distinct().select("part", F.lit(-1).cast("long").alias("place"), title[F.col("part")].alias("line")))
    titled.repartitionByRange("part", "place").sortWithinPartitions("part", "place").select("line").write.mode("overwrite").text(path)


def batch_checks(files: DataFrame, df: DataFrame, chunk_counts: DataFrame) -> DataFrame:
    """(file_id, checked, issue): the failed checks of each file of a batch; pages in an issue are ten at most.

    files: file_id, there, corrupt, expected, chunked (whether there is a chunk file). df as for evaluated(); chunk_counts:
    file_id, chunk_count.
    """
    bad = F.coalesce("is_boilerplate", F.lit(False))
    blank = (F.col("type") != "blank_page") & ~bad & (T.strip(F.coalesce("text", F.lit(""))) == "")
    odd = ~F.coalesce(F.col("type").isin(P.BLOCK_TYPES), F.lit(False))
    stats = df.groupBy("file_id").agg(
        F.count("*").alias("blocks"), F.count_if(~bad).alias("content"), F.count_if(F.coalesce(blank, F.lit(False))).alias("blank"), F.count_if(odd).alias("odd"),
        F.count_if(F.col("is_boilerplate").isNull()).alias("untagged"), F.count_if(F.col("entities").isNull()).alias("plain"), F.collect_set("page_num").alias("seen"),
    )
    out = files.join(stats, "file_id", "left").join(chunk_counts, "file_id", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    every = F.when(F.col("expected") > 0, F.sequence(F.lit(1), F.col("expected"))).otherwise(F.array().cast("array<int>"))
    gaps = F.array_sort(F.array_except(every, F.coalesce("seen", F.array().cast("array<int>"))))
    read = F.col("there") & ~F.coalesce("corrupt", F.lit(False))
    said = lambda check, when, text: F.when(when, F.struct(F.lit(check).alias("checked"), text.alias("issue")))
    counted = lambda c, what: F.concat(n(c).cast("string"), F.lit(f" {what}"))
    checks = [
        said(1, ~F.col("there"), F.lit("extraction missing")),
        said(2, F.col("there") & ~F.col("chunked"), F.lit("chunks missing")),
        said(3, F.col("there") & ~read, F.lit("extraction corrupt")),
        said(4, read & (n("blocks") == 0), F.lit("no blocks")),
        said(5, read & (n("blocks") > 0) & (n("content") == 0), F.lit("no content blocks")),
        said(6, read & (F.size(gaps) > 0), F.concat(F.lit("missing pages "), F.array_join(F.slice(gaps, 1, 10), ","))),
        said(7, read & (n("blank") > 0), counted("blank", "empty texts")),
        said(8, read & (n("odd") > 0), counted("odd", "invalid types")),
        said(9, read & (n("untagged") > 0), counted("untagged", "untagged blocks")),
        said(10, read & (n("plain") > 0), counted("plain", "blocks without entities")),
        said(11, read & F.col("chunked") & (n("chunk_count") == 0), F.lit("no chunks")),
    ]
    return out.select("file_id", F.explode(F.array_compact(F.array(*checks))).alias("x")).select("file_id", "x.*")
