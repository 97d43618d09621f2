"""Edge cases of the document operators that the tables don't hold."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from leafworks import settings
from leafworks.functions import patterns as P
from leafworks.functions import text as T
from leafworks.operators import audit, blocks, boilerplate, chunks, entities, registry, sequences, tables, vectors
from leafworks.sources import files, html
from leafworks.streaming import ingest


def frame(spark, rows, schema="file_id string, page_num int, doc_id long, seq int, type string, text string"):
    return spark.createDataFrame(rows, schema)


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "k int, text string")


def one(spark, values, f):
    return [r.x for r in texts(spark, values).orderBy("k").select(f(F.col("text")).alias("x")).collect()]


def fold(parts, size, overlap):
    out, cur, ids = [], "", []
    for k, t in parts:
        t = t.strip()
        if not t:
            continue
        if cur and len(cur) + len(t) > size:
            out.append((cur.strip(), ids))
            cur, ids = (cur[-overlap:] if len(cur) > overlap else "") + " " + t, [k]
        else:
            cur, ids = (cur + " " + t).strip(), ids + [k]
    return out + ([(cur.strip(), ids)] if cur else [])


@pytest.mark.parametrize("parts", [[], ["x" * 50], ["a" * 10, "b" * 10], ["a" * 10, "b" * 11], ["a" * 4, "b" * 19, "c" * 3], ["a", "", " ", "b"], ["é" * 9, "ü" * 9, "z z z"]])
def test_chunk_fold(spark, parts):
    rows = [("f", 1, 7, k, "", t) for k, t in enumerate(parts)]
    found = chunks.chunks(frame(spark, rows), size=20, overlap=5).orderBy("chunk_no").collect()
    assert [(r.text, r.block_ids) for r in found] == fold(list(enumerate(parts)), 20, 5)
    assert [r.character_count for r in found] == [len(r.text) for r in found]


@pytest.mark.parametrize(("links", "want"), [("cp", ["A", "B"]), ("cc", ["A B"]), ("ccc", ["A B", "C"]), ("cccc", ["A B", "C D"]), ("ccpcc", ["A B", "C", "D E"])])
def test_captions_pair_greedily(spark, links, want):
    rows = [("f", 1, 1, k, {"c": "caption", "p": "paragraph"}[c], "ABCDE"[k]) for k, c in enumerate(links)]
    assert [r.text for r in sequences.captions_joined(frame(spark, rows)).orderBy("seq").collect()] == want


def test_sentences_merge_over_pages(spark):
    rows = [("f", 1, 1, 0, "paragraph", "The war"), ("f", 2, 2, 0, "paragraph", "went on and"), ("f", 3, 3, 0, "paragraph", "ended."), ("f", 4, 4, 0, "paragraph", "No stop"), ("f", 5, 5, 0, "paragraph", "Capital"), ("f", 7, 7, 0, "paragraph", "far")]
    found = sequences.sentences_merged(frame(spark, rows)).orderBy("doc_id").collect()
    assert [(r.text, r.was_corrected) for r in found] == [("The war went on and", True), ("ended.", False), ("No stop", False), ("Capital", False), ("far", False)]


def test_boilerplate_order(spark):
    cases = {"": None, "Page 3 of 9": "footer", "12": "footer", "Chapter 4": "header", "Check Your Progress 1": "exercise_heading", "doi: 10.1234 www.a.in": "bibliography", "visit www.abc.in": "copyright", "Intro ...... 5": "toc", "Confidential": "watermark", "words": None, "Unit 2": "header"}
    assert one(spark, list(cases), boilerplate.boilerplate_type) == list(cases.values())
    at = texts(spark, ["short", "chapter notes"]).select(boilerplate.boilerplate_type(F.col("text"), F.lit(10)).alias("low"), boilerplate.boilerplate_type(F.col("text"), F.lit(830)).alias("high")).collect()
    assert [tuple(r) for r in at] == [("footer", None), ("footer", "header")]


def test_repeats_need_three_pages_and_short_lines(spark):
    rows = [("f", p, p, 0, "", t) for t, pages in (("two", 2), ("three", 3), ("x" * 119, 3), ("y" * 120, 3)) for p in range(pages)]
    assert {r.line for r in blocks.repeating(frame(spark, rows)).collect()} == {"three", "x" * 119}


def test_text_rules(spark):
    assert one(spark, ["ﬁne “q” ​", "co-\n  operate", "thal thal nol", "Y ork V ol. 2", "a   b\n\n\n\nc"], T.basic_correction) == ['fine "q" •', "cooperate", "that that not", "York Vol. 2", "a b\n\nc"]
    long = texts(spark, ["The the war", "see http://a.in/x y.html z", "due to the Visual Culture", "ri Khyat Visual Culture and", "a volk b *volk*"])
    assert [r.corrected for r in T.corrected(long).orderBy("k").collect()] == ["The war", "see http://a.in/xy.html z", "due to the", "ri Khyat and", "a *volk* b *volk*"]
    assert one(spark, ["  x\t\n", " "], T.strip) == ["x", ""]
    assert one(spark, ["file:chk_0001", "é"], T.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, s)) for s in ("file:chk_0001", "é")]


def test_entities_keep_the_earlier_label(spark):
    found = entities.with_entities(texts(spark, ["Article 21A and the Finance Act, 1994 by RBI", None, ""])).orderBy("k").collect()
    assert [(e.label, e.text) for e in found[0].entities][0] == ("CONSTITUTIONAL_ARTICLE", "Article 21A")
    spans = sorted((e.start, e.end) for e in found[0].entities)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)) and [len(r.entities) for r in found[1:]] == [0, 0]


def test_tables(spark):
    rows = [(1, [], []), (2, ["a"], [["x"]]), (3, ["Column_1", ""], [["x", "y"]]), (4, ["a", "b"], [["x", ""], ["y", "z"]]), (5, ["a", "b"], [["x", "w"], ["y", "z"], ["p", ""], ["q", "r"], ["s", ""]]), (6, ["1", "2"], [["x", "x"], ["y", "z"]])]
    t = spark.createDataFrame(rows, "k int, headers array<string>, rows array<array<string>>").orderBy("k")
    assert [r[0] for r in t.select(tables.degenerate(F.col("headers"), F.col("rows"))).collect()] == ["empty", "single_cell", "generic_headers", "sparse_rows", None, None]
    assert [r[0] for r in t.select(tables.toc_like(F.col("rows"))).collect()] == [False, False, False, False, False, True]


def test_table_headers(spark):
    cases = [(["0", "1"], ["Section / Unit", "Page Number"]), (["0", "1", "2"], ["Column_1", "Column_2", "Column_3"]), (["7", "7", "41"], ["Column_8", "Column_8", "Column_42"]), (["0"], ["Column_1"]), (["0", "a"], ["0", "a"]), ([], [])]
    t = spark.createDataFrame([(k, h) for k, (h, _) in enumerate(cases)], "k int, headers array<string>").orderBy("k")
    assert [r[0] for r in t.select(tables.clean_headers(F.col("headers"))).collect()] == [w for _, w in cases]


def test_table_repair(spark):
    many = [f"c{k}" for k in range(10_005)]
    cases = [
        (["p", "h"], [["Page Nos.", "1"], ["", "2"], ["(Source: Kumar, p. 3)", ""]], "", (["p", "h"], [["Page Nos.", "1"], ["", "2"]], "(Source: Kumar, p. 3)")),
        (["p", "h"], [["x", "1"], ["(Source: Kumar, p. 3)", ""], ["", "(Press, 2001)"]], "", (["p", "h"], [["x", "1"]], "(Source: Kumar, p. 3) ((Press, 2001))")),
        (["p", "h"], [["x", "1"], ["(Unit 3)"]], "Given", (["p", "h"], [["x", "1"]], "Given ((Unit 3))")),
        (["<!-- image -->", "h"], [["a<!-- b", "1"], []], "", (["Col_1", "h"], [["", "1"], []], "")),
        (["BHIC", *many], [["bhic-101", *many], []], "", (many, [many], "")),
        ([], [["bhic-101"]], "", ([], [["bhic-101"]], "")),
    ]
    # A first column that is all boilerplate or empty goes; the fourth table's does too.
    cases[3] = (*cases[3][:3], (["h"], [["1"]], ""))
    df = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(cases)], "k int, headers array<string>, rows array<array<string>>, caption string")
    found = tables.repaired(df).orderBy("k").collect()
    assert [(r.headers, r.rows, r.caption) for r in found] == [c[3] for c in cases]


def test_rows_of_dropped_tables(spark):
    shape = "file_id string, page_num int, doc_id long, headers array<string>, rows array<array<string>>"
    rows = [("f", 1, 1, ["h"], [["One  line"]]), ("f", 2, 2, ["h", "i"], [["Intro ....... 5", ""], ["there", "is"], ["x ...... 2", ""]]), ("f", 3, 3, ["h"], [["one line"]]), ("g", 1, 9, ["a", "b"], [["x", ""], ["y", "z"]]), ("g", 2, 8, ["a", "b"], [["x", "w"], ["y", "z"]])]
    t = spark.createDataFrame(rows, shape)
    there = frame(spark, [("f", 7, 7, 0, "paragraph", "THERE   is"), ("g", 7, 7, 0, "paragraph", "One line")])
    found = {(r.file_id, r.page_num, r.type, r.text, r.is_boilerplate, r.boilerplate_type, r.was_corrected) for r in tables.rescued_rows(t, there).collect()}
    assert found == {("f", 2, "toc", "Intro ....... 5", True, "toc", False), ("f", 2, "toc", "x ...... 2", True, "toc", False), ("f", 1, "list_item", "One  line", False, None, True)}
    assert {(r.doc_id, r.needs_review, r.table_id) for r in tables.numbered(tables.kept(t)).collect()} == {(9, True, "tbl_001"), (8, False, "tbl_002")}


def test_colours(spark):
    cases = [((231, 232, 233), None), ((240, 220, 210), None), ((210, 180, 200), "pink_callout"), ((201, 180, 191), "pink_callout"), ((200, 100, 190), None), ((230, 200, 140), "yellow_callout"), ((230, 180, 140), None), ((100, 120, 181), "blue_callout"), ((100, 170, 185), None)]
    df = spark.createDataFrame([(k, *c) for k, (c, _) in enumerate(cases)], "k int, r int, g int, b int").orderBy("k")
    assert [r[0] for r in df.select(blocks.highlight(F.col("r"), F.col("g"), F.col("b"))).collect()] == [w for _, w in cases]


BOXED = "file_id string, page_num int, doc_id long, seq int, type string, text string, x0 double, y0 double, x1 double, y1 double"


def boxes(spark, rows):
    """rows: (type, x0, y0, x1), in order."""
    return spark.createDataFrame([("f", 1, 1, k, t, str(k), x0, y0, x1, None if y0 is None else y0 + 5.0) for k, (t, x0, y0, x1) in enumerate(rows)], BOXED)


def test_reading_order_of_two_columns(spark):
    left, right = [("paragraph", 50.0, 700.0 - 20 * k, 250.0) for k in range(4)], [("paragraph", 300.0, 702.0 - 20 * k, 500.0) for k in range(4)]
    rows = [*right, *left, ("footer", 50.0, 20.0, 90.0), ("header", 200.0, 100.0, 260.0), ("paragraph", None, None, None)]
    order = [r.seq for r in sequences.reading_order(boxes(spark, rows)).orderBy("position").collect()]
    assert order == [9, 4, 5, 6, 7, 0, 1, 2, 3, 8, 10]
    few = [*right[:3], *left[:3], ("paragraph", 40.0, 701.0, 550.0)]
    # One column: bands of six points from the top, then from the left.
    assert [r.seq for r in sequences.reading_order(boxes(spark, few)).orderBy("position").collect()] == [6, 3, 0, 1, 4, 5, 2]


def test_page_reorder_uses_the_detected_middle(spark):
    rows = [("p", 40.0, 800.0, 600.0), ("p", 50.0, 700.0, 200.0), ("p", 222.0, 690.0, 400.0), ("p", 55.0, 680.0, 200.0), ("p", 227.0, 670.0, 400.0), ("p", 40.0, 500.0, 600.0), ("p", 240.0, 450.0, 400.0), ("p", 50.0, 400.0, 200.0), ("p", None, None, None)]
    df = boxes(spark, rows)
    assert sequences.column_midpoint(df, width=450).first().mid == 138.5
    # Half of the width (225) would put the blocks at 222 and 227 into two columns.
    order = [r.seq for r in sequences.page_reorder(df, width=450).orderBy("position").collect()]
    assert order == [0, 1, 3, 2, 4, 5, 7, 8, 6]
    widths = spark.createDataFrame([("f", 1, 2000.0)], "file_id string, page_num int, page_width double")
    assert [r.seq for r in sequences.page_reorder(df, widths).orderBy("position").collect()] == [0, 1, 2, 3, 4, 5, 6, 7, 8]


def test_headings_are_compared_with_the_block_before(spark):
    long = "A heading of which only the end differs " * 4
    rows = [("heading", "One"), ("heading", " ONE "), ("paragraph", "x"), ("heading", "one"), ("heading", f"{long}a"), ("heading", f"{long}b"), ("paragraph", "x"), ("paragraph", "x")]
    df = frame(spark, [("f", 1, 1, k, t, x) for k, (t, x) in enumerate(rows)] + [("f", 2, 2, 0, "heading", "x"), ("f", 3, 3, 0, "heading", "x")])
    assert [(r.page_num, r.seq) for r in sequences.headings_deduped(df).orderBy("page_num", "seq").collect()] == [(1, k) for k in (0, 2, 3, 4, 5, 6, 7)] + [(2, 0), (3, 0)]


def test_fingerprints_have_compatibility_form(spark):
    rows = ["ﬁne  print", "fine print", "FINE PRINT ", "", " ", None, "x²", "x2", "é", "e\u0301", "a" * 130, "a" * 125]
    found = sequences.consecutive_dedup(frame(spark, [("f", 1, 1, k, "", t) for k, t in enumerate(rows)])).orderBy("seq").collect()
    assert [r.seq for r in found] == [0, 3, 5, 6, 8, 10]


def test_boilerplate_passes(spark):
    toc = "Course Contents: Theme 1 Introduction to the Unit and its Pages " * 4
    rows = [(p, p, 0, "paragraph", "The running title", 500) for p in (1, 2, 3)] + [(p, p, 1, "paragraph", "Activity 3", 500) for p in (1, 2, 3)]
    rows += [(1, 1, 2, "paragraph", toc, 500), (1, 1, 3, "paragraph", "14", 500), (2, 2, 3, "paragraph", "14", 500), (3, 3, 3, "paragraph", "chapter notes", 830), (3, 3, 4, "footer", "1.2 Sources", 500), (3, 3, 5, "footer", "Which of these?", 20), (3, 3, 6, "heading", "1.2 Sources", 20)]
    df = spark.createDataFrame([("f", p, d, s, t, x, y) for p, d, s, t, x, y in rows], "file_id string, page_num int, doc_id long, seq int, type string, text string, y0 int")
    found = boilerplate.rescued_questions(boilerplate.rescued_headings(boilerplate.processed(df)))
    got = {(r.page_num, r.seq): (r.type, r.boilerplate_type, r.is_boilerplate, r.was_corrected) for r in found.collect()}
    assert got == {
        **{(p, 0): ("header", "repeating_header_footer", True, False) for p in (1, 2, 3)}, **{(p, 1): ("exercise_heading", "exercise_heading", False, False) for p in (1, 2, 3)},
        (1, 2): ("paragraph", None, False, False), (1, 3): ("toc_page_number", "toc_page_number", True, False), (2, 3): ("footer", "footer", True, False),
        (3, 3): ("header", "header", True, False), (3, 4): ("heading", None, False, True), (3, 5): ("pyq_question", "footer", False, True), (3, 6): ("footer", "footer", True, False),
    }
    marks = spark.createDataFrame([("ééé a", True), ("abcd é", True), ("ééé", False), ("", True)], "text string, is_boilerplate boolean")
    assert [r.encoding_error for r in boilerplate.with_encoding_errors(marks).collect()] == [True, False, None, None]


def test_splits_that_were_not_merged(spark):
    rows = [(1, "paragraph", "ends without", False), (1, "paragraph", "mark goes on", False), (2, "paragraph", "with a comma,", False), (2, "heading", "not here", False), (3, "paragraph", "a", True), (3, "paragraph", "b’", False), (4, "paragraph", "c", False), (4, "paragraph", "Capital", False)]
    df = spark.createDataFrame([("f", p, p, k, t, x, b) for k, (p, t, x, b) in enumerate(rows)], "file_id string, page_num int, doc_id long, seq int, type string, text string, is_boilerplate boolean")
    assert sequences.unmerged_splits(df).first().unmerged == 3


def test_merge_looks_past_boilerplate(spark):
    rows = [(1, "paragraph", "The war ", False), (1, "footer", "12", True), (2, "header", "Title", True), (2, "paragraph", " went on and", False), (3, "paragraph", "ended", False), (4, "heading", "x", False), (4, "paragraph", "and so", False), (5, "paragraph", "5 more", False)]
    df = spark.createDataFrame([("f", p, p, k, t, x, b, False) for k, (p, t, x, b) in enumerate(rows)], "file_id string, page_num int, doc_id long, seq int, type string, text string, is_boilerplate boolean, was_corrected boolean")
    found = sequences.sentences_merged(df).orderBy("seq").collect()
    assert [(r.seq, r.text, r.was_corrected) for r in found] == [(0, "The war went on and", True), (1, "12", False), (2, "Title", False), (4, "ended", False), (5, "x", False), (6, "and so 5 more", True)]


def test_coverage_of_files_that_lack_pages(spark):
    df = frame(spark, [("f", p, p, 0, "", "x") for p in (1, 2, 4, 7)] + [("g", 1, 9, 0, "", "x"), ("g", 2, 9, 0, "", "x")])
    t = spark.createDataFrame([("f", 3), ("f", 3), ("g", 3)], "file_id string, page_num int")
    expected = spark.createDataFrame([("f", 8), ("g", 2), ("h", 3), ("i", 0)], "file_id string, expected int")
    found = {r.file_id: (r.covered, r.missing_pages, r.coverage_pct) for r in blocks.coverage(df, t, expected).collect()}
    assert found == {"f": (5, "5,6,8", 62.5), "g": (3, "", 150.0), "h": (0, "1,2,3", 0.0), "i": (0, "", 0.0)}
    assert {tuple(r) for r in blocks.missing_pages(df, t, expected).collect()} == {("f", 5), ("f", 6), ("f", 8), ("h", 1), ("h", 2), ("h", 3)}
    got = {(r.page_num, r.missing, r.low, r.blob) for r in blocks.pages_to_recover(df, expected.where("file_id = 'g'")).collect()}
    assert got == {(1, False, True, False), (2, False, True, False)}


def test_pages_are_replaced_by_better_ones(spark):
    df = frame(spark, [("f", 1, 1, 0, "paragraph", "x" * 401), ("f", 2, 2, 0, "paragraph", "x" * 401), ("f", 3, 3, 0, "paragraph", "x")])
    new = frame(spark, [("f", 1, 1, 0, "heading", "a"), ("f", 1, 1, 1, "paragraph", "b"), ("f", 2, 2, 0, "paragraph", "only"), ("f", 3, 3, 0, "heading", "c"), ("f", 3, 3, 1, "heading", "d")])
    found = blocks.pages_replaced(df, new).orderBy("page_num", "seq").collect()
    assert [(r.page_num, r.type, len(r.text)) for r in found] == [(1, "heading", 1), (1, "paragraph", 1), (2, "paragraph", 401), (3, "paragraph", 1)]


def test_collapsed_paragraphs(spark):
    lines = "\n".join(["Chapter 4", "plain one", "12", "1234", "1. item", "plain two"] + [""] * 400)
    df = spark.createDataFrame([(1, "paragraph", lines), (2, "caption", lines), (3, "paragraph", " kept as it is "), (4, "paragraph", None)], "doc_id long, type string, text string")
    found = {(r.doc_id, r.part): (r.type, r.text) for r in blocks.split_collapsed(df).collect()}
    assert found == {(1, 0): ("heading", "Chapter 4"), (1, 2): ("footer", "12"), (1, 4): ("list_item", "1. item"), (1, 406): ("paragraph", "plain one 1234 plain two"), (2, -1): ("caption", lines), (3, -1): ("paragraph", " kept as it is "), (4, -1): ("paragraph", None)}


def test_noise_by_type(spark):
    rows = [("paragraph", "7"), ("heading", "7"), ("footer", "-"), ("list_item", "–"), ("blank_page", ""), ("paragraph", " "), ("heading", "2019–20"), ("paragraph", "BoxShadow"), ("paragraph", "77")]
    found = blocks.noise_free(frame(spark, [("f", 1, 1, k, t, x) for k, (t, x) in enumerate(rows)]))
    assert {r.seq for r in found.collect()} == {1, 3, 4, 8}


def test_lines_become_blocks(spark):
    rows = [("Chapter 3", 300.0, 500.0), ("body left", 200.0, 600.0), ("goes on", 200.0, 640.0), ("right side", 700.0, 510.0), ("running", 500.0, 50.0), ("12", 500.0, 700.0), ("1. item", 200.0, 700.0), ("after", 200.0, 720.0), ("foot", 500.0, 1390.0)]
    df = spark.createDataFrame([("f", 1, k, t, x, y, 1000.0, 1400.0) for k, (t, x, y) in enumerate(rows)], "file_id string, page_num int, line_no int, text string, xc double, yc double, width double, height double")
    found = [(r.type, r.text) for r in sequences.zoned_blocks(df).orderBy("place").collect()]
    assert found == [("header", "running"), ("heading", "Chapter 3"), ("paragraph", "body left goes on"), ("list_item", "1. item"), ("paragraph", "after right side"), ("footer", "12"), ("footer", "foot")]


def test_paragraphs_by_geometry(spark):
    rows = [("one", 40, 0, 20), ("two", 40, 25, 45), ("indented", 55, 50, 70), ("far", 55, 98, 118), ("ends.", 55, 120, 140), ("Capital", 55, 151, 171), ("close.", 55, 172, 192), ("Next", 55, 200, 220), ("Exercises", 55, 221, 241), ("x", 55, 242, 262)]
    df = spark.createDataFrame([("f", 1, 1, k, t, float(x), float(a), float(b)) for k, (t, x, a, b) in enumerate(rows)], "file_id string, page_num int, column int, line_no int, text string, min_x double, min_y double, max_y double")
    found = [(r.type, r.text) for r in sequences.column_blocks(df).orderBy("place").collect()]
    assert found == [("paragraph", "one two"), ("paragraph", "indented"), ("paragraph", "far ends."), ("paragraph", "Capital close. Next"), ("heading", "Exercises"), ("paragraph", "x")]


def test_summaries_are_no_pages(spark):
    cases = [(["In Summary the page"], True), (["a", "b", " - **c**"], False), (["x\n- **c**"], True), (["*   **c**", "b"], True), ([], False)]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "k int, texts array<string>").orderBy("k")
    assert [r[0] for r in df.select(blocks.summary_like(F.col("texts"))).collect()] == [w for _, w in cases]


def test_covering_rectangles(spark):
    df = boxes(spark, [("p", 0.0, 0.0, 10.0), ("p", 100.0, 0.0, 110.0), ("p", 200.0, 0.0, 210.0), ("p", 300.0, 0.0, 300.0), ("p", None, None, None)])
    rects = spark.createDataFrame([("f", 1, x, 0.0, x + w, 5.0 if w < 500 else 500.0, c, c, c) for x, w, c in ((0.0, 9.0, 0.95), (100.0, 10.0, 0.9), (195.0, 600.0, 1.0), (300.0, 5.0, 1.0))] + [("f", 1, 100.0, 0.0, 110.0, 5.0, None, None, None)], "file_id string, page_num int, rx0 double, ry0 double, rx1 double, ry1 double, r double, g double, b double")
    sizes = spark.createDataFrame([], "file_id string, page_num int, width double, height double")
    assert {r.seq for r in sequences.covered(df, sequences.white_rects(rects, sizes)).collect()} == {1, 2, 3, 4}


def test_html_keeps_text_inside_inner_tags(spark):
    html_text = '<nav><ul><li><a href="/x">one</a></li></ul></nav><p class="c">a <b>b</b> c<br>d <P>next</p> loose<h1>T</h1><footer>end</footer><pre>no</pre>'
    found = html.html_blocks(spark.createDataFrame([(1, html_text), (2, None), (3, "")], "page_id long, html string")).orderBy("seq").collect()
    assert [(r.type, r.text) for r in found] == [("list_item", "one"), ("paragraph", "a b c d"), ("paragraph", "next"), ("heading", "T"), ("footer", "end")]


def test_fences(spark):
    cases = [("```json\n[1]\n```", "[1]"), (" [1] ", "[1]"), ("```\na", "a"), ("a\n```", "a"), ("```", ""), ("a ``` b", "a ``` b")]
    assert one(spark, [c for c, _ in cases], T.without_fences) == [w for _, w in cases]


def test_answers_become_blocks(spark):
    raw = '```json\n[{"type": "heading", "text": " A "}, 7, {"text": "b", "is_boilerplate": true}, {"type": "footer", "text": "12", "is_boilerplate": true}, {"text": " "}]\n```'
    df = spark.createDataFrame([(5, raw), (6, '{"text": "one"}')], "doc_id long, raw string")
    found = {(r.doc_id, r.block_id): (r.type, r.text, r.is_boilerplate, r.boilerplate_type) for r in files.normalized_blocks(df, "raw").collect()}
    assert found == {(5, "blk_p0005_001"): ("heading", "A", False, None), (5, "blk_p0005_003"): ("paragraph", "b", True, None), (5, "blk_p0005_004"): ("footer", "12", True, "footer"), (6, "blk_p0006_001"): ("paragraph", "one", False, None)}


def plainly_corrected(text):
    """All rules of correction, by Python's own engine."""
    for a, b in P.CHARACTERS:
        text = text.replace(a, b)
    text = re.sub(P.HYPHEN_BREAK, r"\1\2", text)
    for a, b in [*P.DOMAIN_TERMS, *P.CONFUSIONS, *P.SPLIT_WORDS]:
        text = re.sub(a, b, text)
    text = re.sub(r"\b([a-zA-Z]{3,})\s+\1\b", r"\1", text, flags=re.I)
    text = re.sub(rf"(\w)\s+([{P.DIACRITICS}])\s*(\w)", r"\1\2\3", text)
    text = re.sub(rf"(\w)\s+([{P.DIACRITICS}])", r"\1\2", text)
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]{2,}", " ", text))
    while (new := re.sub(P.URL_SPACE, r"\1\2", text)) != text:
        text = new
    tails = (re.sub(rf"\s*{re.escape(h)}\s*$", "", text) for h in P.RUNNING_HEADERS)
    text = next((t.rstrip() for t in tails if t != text), text)
    for h in P.RUNNING_HEADERS:
        text = re.sub(rf"(?<=\w)\s+{re.escape(h)}\s+(?=\w)", " ", text, count=1)
    for t in P.FOREIGN_TERMS:
        text = re.sub(rf"(?<![*])\b({re.escape(t)})\b(?![*])", r"*\1*", text)
    return text.strip()


WORDS = ["thal", "il", "The", "the", "V ol.", "S  hah", "co-\n oper", "jihad", "*volk*", "blitzkrieg.", "http://a.in/x y.html", "https://b.org/a  b/c d/", "Hir ṇ ayak ṣ a", "ā", "Visual Culture", "Society and Culture", "éil", "ilé", "U.P.S.C.", "ﬁ", "…", "“x”", "\n\n\n\n", "\t ", "12", "word", "Courtly Culture", "x"]


def test_correction_against_plain_python(spark):
    import random

    r = random.Random(4)
    values = [r.choice([" ", "  ", ""]).join(r.choice(WORDS) for _ in range(r.randint(0, 9))) for _ in range(600)] + ["Visual Culture", "onVisual Culture ", "a Visual Culture b Visual Culture c"]
    found = T.corrected(texts(spark, values)).orderBy("k").collect()
    assert [x.corrected for x in found] == [plainly_corrected(v) for v in values]
    done = T.corrected_blocks(texts(spark, values).withColumn("was_corrected", F.lit(True))).orderBy("k").collect()
    assert all((x.text, x.raw_text, x.was_corrected) == ((plainly_corrected(v), v, True) if plainly_corrected(v) != v.strip() else (v, None, False)) for x, v in zip(done, values, strict=True))


def test_entities_against_plain_python(spark):
    import random

    r = random.Random(6)
    parts = ["Article 21A", "art. 5", "the Finance Act, 1994", "finance act", "policy 2001", "code of things 1901", "by RBI", "reserve old bank", "PM-kisan", "quit india movement", "battle of x", "1857", "12 may 2001", "3rd june 1999", "42nd constitutional amendment act", "words", ";", ".", "é1994", "a, b", "new policy, 1999"]
    values = [" ".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(500)]

    def plainly(text):
        taken, out = [], []
        for label, p in P.ENTITIES:
            for m in re.finditer(p, text):
                if all(m.end() <= a or m.start() >= b for a, b in taken):
                    taken.append(m.span())
                    out.append((m.group().strip(), label, m.start(), m.end()))
        return sorted(out, key=lambda e: e[2])

    found = entities.with_entities(texts(spark, values)).orderBy("k").collect()
    assert [[tuple(e) for e in x.entities] for x in found] == [plainly(v) for v in values]


def test_page_dedup_looks_back_over_four_pages(spark):
    same = " ".join(f"w{k}" for k in range(30))
    pages = [("f", p, same if p in (1, 4, 9) else " ".join(f"p{p}_{k}" for k in range(30))) for p in range(1, 10)] + [("f", 10, "short"), ("f", 11, "short")]
    kept = {r.page_num for r in sequences.page_dedup(frame(spark, pages, "file_id string, page_num int, text string"), P.SAME_TOPIC_WORDS).collect()}
    assert kept == {*range(1, 12)} - {4}


def test_retrieval_measures(spark):
    ranks = spark.createDataFrame([(1,), (0,), (2,), (7,)], "rank int")
    r = vectors.measures(ranks).first()
    assert (r.queries, r.recall5, r.recall10) == (4, 0.5, 0.75) and abs(r.mrr - (1 + 0.5 + 1 / 7) / 4) < 1e-6


def test_registry(spark):
    changes = spark.createDataFrame([("a", 1, "x", "e"), ("a", 2, None, "f"), ("b", 1, None, None)], "id string, at int, path string, status string")
    assert {tuple(r) for r in registry.latest(changes, "id", "at", ["path", "status"]).collect()} == {("a", 2, "x", "f"), ("b", 1, None, None)}


def test_rating_and_confidence(spark):
    s = spark.range(1).select(
        audit.confidence(F.lit(150.0), F.lit(9), F.lit(0), F.lit(0), F.lit(0)).alias("top"), audit.confidence(F.lit(0.0), F.lit(0), F.lit(9), F.lit(0), F.lit(0)).alias("low"),
        audit.confidence(F.lit(90.0), F.lit(8), F.lit(1), F.lit(0), F.lit(1)).alias("mid"), T.half_even(F.lit(62.25), 1).alias("tie"), T.half_even(F.lit(62.35), 1).alias("up"),
    ).first()
    assert (s.top, s.low, s.mid, s.tie, s.up) == (100.0, 0.0, 77.8, 62.2, 62.4)
    assert [r[0] for r in spark.createDataFrame([(90.0,), (89.9,), (60.0,), (10.0,)], "s double").select(audit.rating(F.col("s"))).collect()] == ["Excellent", "Good", "Fair", "Poor"]


def test_audit_of_files(spark):
    blocks_ = "file_id string, page_num int, doc_id long, seq int, type string, text string, is_boilerplate boolean, was_corrected boolean, entities array<string>, x0 double, y0 double, x1 double, y1 double"
    box = (1.0, 2.0, 3.0, 4.0)
    ok = [("good", p, p, 0, "paragraph", f"A sentence of page {p}.", False, p == 1, ["e"], *box) for p in (1, 2)]
    bad = [("bad", 1, 5, 0, "odd", "V ol and so", False, None, None, 0.0, 0.0, 595.0, 842.0), ("bad", 1, 5, 1, "paragraph", " ", None, None, [], *box)]
    df = spark.createDataFrame(ok + bad, blocks_)
    t = spark.createDataFrame([("bad", 1, "tbl_001", None), ("good", 2, "tbl_001", [["x"]])], "file_id string, page_num int, table_id string, rows array<array<string>>")
    known = "file_id string, there boolean, expected int, corrupt boolean, file_name string, extracted_at string, chunked boolean"
    found = spark.createDataFrame([("good", True, 2, False, "g.pdf", "now", True), ("bad", True, 3, False, "b.pdf", None, True), ("lost", False, 4, False, None, None, False), ("broken", True, 1, True, "c", "now", True), ("none", True, 1, False, "n", "now", False)], known)
    rules = {r.file_id: r for r in audit.rules(found, df, t).collect()}
    assert {k: r.passed for k, r in rules.items()} == {"good": 9, "bad": 3, "lost": 1, "broken": 0, "none": 2}
    assert [n for n in audit.RULES if rules["bad"][n]] == ["valid_json", "has_blocks", "pages_valid"]
    scored = {r.file_id: r for r in audit.evaluated(found, df, t).collect()}
    g, b, lost = scored["good"], scored["bad"], scored["lost"]
    assert (g.score, g.rating, g.ready, g.coverage_pct, g.corrected_blocks, g.entity_count, g.table_count) == (100.0, "Excellent", True, 100.0, 1, 2, 1)
    assert (b.coverage_pct, b.passed, b.high, b.medium, b.low, b.score) == (33.33, 3, 1, 1, 1, round(100 - 0.3 * 66.67 - 2.2 * 6 - 15 - 5 - 2, 1))
    assert (lost.score, lost.rating, lost.high, lost.total_blocks) == (0.0, "Poor", 1, 0)
    counts = spark.createDataFrame([("good", 4), ("broken", 2)], "file_id string, chunk_count long")
    checks = sorted((r.file_id, r.checked, r.issue) for r in audit.batch_checks(found, df, counts).collect())
    assert checks == [
        ("bad", 6, "missing pages 2,3"), ("bad", 7, "1 empty texts"), ("bad", 8, "1 invalid types"), ("bad", 9, "1 untagged blocks"), ("bad", 10, "1 blocks without entities"), ("bad", 11, "no chunks"),
        ("broken", 3, "extraction corrupt"), ("lost", 1, "extraction missing"), ("none", 2, "chunks missing"), ("none", 4, "no blocks"), ("none", 6, "missing pages 1"),
    ]
    total = {r.folder: r for r in audit.ratings(audit.evaluated(found, df, t), F.lit("a")).collect()}
    assert total["TOTAL"].documents == 5 and total["a"].ready == 1 and audit.report(audit.evaluated(found, df, t)).where("file_id = 'good'").first().line == "| good | 100.0 | Excellent | 100.0 | yes |"


def test_files(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    for name, data in {"a.pdf": b"%PDF-1.7 x", "sub/b.pdf": b"nope!!", "c.pdf": b"", "d.txt": b"%PDF-"}.items():
        (tmp_path / "in" / name).write_bytes(data)
    listed = files.listed(spark, f"file://{tmp_path}/in")
    found = {re.sub(".*/", "", r.path): r.errors for r in files.validated(files.with_heads(listed)).collect()}
    assert found == {"a.pdf": [], "b.pdf": ["header"], "c.pdf": ["empty"], "d.txt": ["extension"]}
    assert files.listed(spark, f"file://{tmp_path}/nothing").count() == 0
    assert [re.sub(".*/", "", r.path) for r in files.files(spark, f"file://{tmp_path}/in").orderBy("path").collect()] == ["a.pdf", "b.pdf"]
    rows = spark.createDataFrame([("x.txt", 0, b"", None), ("y.pdf", 2 << 27, b"%PDF-", 3), ("z.pdf", 9, b"%PDF-", 0), ("zz.pdf", 9, None, None)], "path string, length long, head binary, page_count int")
    assert [r.errors for r in files.validated(rows).orderBy("path").collect()] == [["empty"], ["size"], ["no_pages"], ["unreadable"]]


def test_chunk_documents_round_trip(spark, tmp_path):
    rows = [("f", p, 7, p, "", "word " * 90) for p in range(1, 6)]
    made = chunks.chunks(frame(spark, rows))
    files.write_chunks(chunks.documents(made), f"file://{tmp_path}/c")
    back = files.read_chunks(spark, f"file://{tmp_path}/c").orderBy("chunk_id").collect()
    want = made.orderBy("chunk_no").collect()
    assert [(r.chunk_id, r.text, r.character_count, r.page_numbers) for r in back] == [(r.chunk_id, r.text, r.character_count, r.pages) for r in want]
    assert [r.page_numbers for r in back] == [[1, 2], [3], [4], [5]] and back[0].block_ids == ["blk_0002", "blk_0003"]


def test_uploads_and_engines(spark):
    rows = [(1, "a.pdf", "History"), (2, "a.PDF", "Anthropology"), (3, "a.txt", "History"), (4, "a.txt", "Maths"), (5, None, "History"), (6, "a.pdf", None)]
    df = spark.createDataFrame(rows, "k int, file_name string, classification string").orderBy("k")
    assert [r.error for r in registry.intake(df, ["History", "Anthropology"]).collect()] == [None, None, "extension", "classification", "extension", "classification"]
    assert df.select(registry.upload_path("up", F.col("classification"), F.lit("id"))).first()[0] == "up/history/id.pdf"
    cases = [(True, None, "vlm"), (False, None, "layout"), (None, None, "vlm"), (True, "Layout", "layout"), (False, "VLM", "vlm")]
    e = spark.createDataFrame([(k, *c[:2]) for k, c in enumerate(cases)], "k int, scanned boolean, forced string").orderBy("k")
    assert [r[0] for r in e.select(registry.engine(F.col("scanned"), F.col("forced"))).collect()] == [c[2] for c in cases]


def test_settings(monkeypatch):
    monkeypatch.setenv("LEAFWORKS_CHUNK_SIZE", "500")
    monkeypatch.setenv("LEAFWORKS_CLASSES", "A, B")
    found = settings.from_environment()
    assert (found.chunk_size, found.chunk_overlap, found.classes) == (500, 200, ("A", "B"))


def test_stamps_and_figures(spark):
    row = registry.stamped(spark.range(1)).first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00", row.extracted_at)
    sizes = [(59, 100, 5000), (60, 60, 3000), (100, 100, 2999), (0, 0, 3000), (None, 61, 9000)]
    df = spark.createDataFrame([(k, *s) for k, s in enumerate(sizes)], "k int, width int, height int, bytes long")
    assert {r.k for r in blocks.figures(df).collect()} == {1, 3, 4}


def test_collections(spark):
    registry.ensure_collection(spark, "history_chunks", "id string, vector array<float>")
    spark.sql("INSERT INTO history_chunks VALUES ('a', array(1.0f))")
    registry.ensure_collection(spark, "history_chunks", "id string, vector array<float>")
    assert spark.table("history_chunks").count() == 1 and "history_chunks" in registry.collections(spark)
    registry.ensure_collection(spark, "history_chunks", "id string, vector array<float>", reset=True)
    assert spark.table("history_chunks").count() == 0
    registry.drop_collections(spark, {"history_chunks"})
    assert "history_chunks" not in registry.collections(spark)
    empty = spark.createDataFrame([], "chunk_id string, text string")
    assert vectors.corpus(empty, spark.createDataFrame([("c1", "x")], "chunk_id string, text string")).count() == 1


def test_nearest_against_plain_products(spark):
    import numpy as np

    r = np.random.default_rng(1)
    v = r.normal(size=(300, 8)).astype("float32")
    v[50] = v[100]
    df = spark.createDataFrame([(k, k % 3, [float(x) for x in v[k]]) for k in range(300)], "vec_id long, label int, embedding array<float>").repartition(5)
    found = {(x.query_id, x["rank"]): x.vec_id for x in vectors.nearest(df.where("vec_id % 50 = 0"), df).collect()}
    u = v.astype("float64") / np.linalg.norm(v.astype("float64"), axis=1, keepdims=True)
    for k in range(0, 300, 50):
        scores = np.round(u @ u[k], 6)
        want = sorted((j for j in range(300) if j != k), key=lambda j: (-scores[j], j))[:10]
        assert [found[k, n] for n in range(1, 11)] == want


def test_documents_round_trip_and_corrupt_ones(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j/good.json").write_text('{"document_metadata": {"file_name": "f.pdf"},\n "text_blocks": [{"block_id": "blk_0001", "page_num": 1, "text": "x"}]}')
    (tmp_path / "j/bad.json").write_text("{nope")
    docs = files.read_documents(spark, f"file://{tmp_path}/j").cache()
    assert docs.where("_corrupt_record is not null").count() == 1 and docs.where("document_metadata.file_name = 'f.pdf'").count() == 1
    files.write_documents(docs.where("_corrupt_record is null").drop("_corrupt_record"), f"file://{tmp_path}/out")
    assert files.read_documents(spark, f"file://{tmp_path}/out").first().text_blocks[0].block_id == "blk_0001"


def test_stream_upserts_by_key(spark, tmp_path):
    (tmp_path / "s").mkdir()
    write = lambda name, rows: (tmp_path / "s" / name).write_text("\n".join(rows))
    path, shape = f"file://{tmp_path}/t", "id int, v string"
    for name, rows in (("1.json", ['{"id": 1, "v": "a"}', '{"id": 2, "v": "b"}']), ("2.json", ['{"id": 2, "v": "c"}'])):
        write(name, rows)
        stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).json(f"file://{tmp_path}/s")
        ingest.upsert_stream(stream, lambda d: d, path, "id", f"file://{tmp_path}/ck").awaitTermination()
    assert {tuple(r) for r in ingest.current(spark, path, shape, "id").collect()} == {(1, "a"), (2, "c")}
    ingest.compacted(spark, path, shape, "id", f"file://{tmp_path}/new")
    assert {tuple(r) for r in ingest.current(spark, f"file://{tmp_path}/new", shape, "id").collect()} == {(1, "a"), (2, "c")}


def test_correction_rejoins_diacritics_and_long_addresses(spark):
    split = "http://a.in/" + " ".join(f"p{k}/" for k in range(20))
    rows = [(0, "Hir ṇ ayak ṣ a"), (1, "Pur ā"), (2, f"see {split} end"), (3, "a ṇ"), (4, "plain text")]
    found = T.corrected(spark.createDataFrame(rows, "k int, text string"))
    want = ["Hirṇayakṣa", "Purā", "see " + split.replace(" ", "") + " end", "aṇ", "plain text"]
    assert [r.corrected for r in found.orderBy("k").collect()] == want
