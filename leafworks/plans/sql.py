"""DuckDB SQL for the registered queries, built from the same fixed values."""

from __future__ import annotations

from leafworks.functions import patterns as P
from leafworks.plans.planted import PLANTS
from leafworks.sources.html import BLOCK_TAG, SPACE_TAG

ORACLE_SQL: dict[str, str] = {}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(text: str, patterns: list[str]) -> str:
    return f"regexp_matches({text}, {q(P.any_of(patterns))})"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+|[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+$', '', 'g')"


def norm(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '[\\s\\x0B\\x{{85}}\\p{{Z}}]+', ' ', 'g')))"


def rounded(x: str, digits: int) -> str:
    """x rounded by its exact binary value, ties to even: the product with the power of ten and what its rounding lost."""
    m, k = 10.0**digits, 134217729.0
    mh = m * k - (m * k - m)
    v, h = "v[1]", "v[2]"
    lost = f"((({h} * {mh}::DOUBLE - v[3]) + {h} * {m - mh}::DOUBLE + ({v} - {h}) * {mh}::DOUBLE) + ({v} - {h}) * {m - mh}::DOUBLE)"
    tie = "abs(v[3] - round_even(v[3], 0)) = 0.5"
    exact = f"CASE WHEN {tie} AND {lost} > 0 THEN v[3] + 0.5::DOUBLE WHEN {tie} AND {lost} < 0 THEN v[3] - 0.5::DOUBLE ELSE round_even(v[3], 0) END / {m}::DOUBLE"
    parts = f"list_transform([CAST({x} AS DOUBLE)], lambda x: [x, x * {k}::DOUBLE - (x * {k}::DOUBLE - x), x * {m}::DOUBLE])"
    return f"list_transform({parts}, lambda v: CASE WHEN abs(v[3]) < {2.0**52}::DOUBLE THEN {exact} ELSE v[1] END)[1]"


def isin(c: str, values: list[str]) -> str:
    return f"{c} IN ({', '.join(map(q, values))})"


def lines(source: str = "documents") -> str:
    """The CTE of blocks: a row per line of the source's texts."""
    return f"""lines AS (SELECT *, {strip('text')} AS line FROM (
      SELECT concat(source, '-', doc_id // 2000) AS file_id, CAST(doc_id % 2000 // 20 + 1 AS INTEGER) AS page_num, doc_id,
        CAST(generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS INTEGER) AS seq,
        unnest(string_split(coalesce(text, ''), chr(10))) AS text FROM {source}))"""


PLANT = f"[{', '.join(q(p) for p in PLANTS)}][doc_id % 10 + 1]"
PLANTED = f"(SELECT doc_id, source, lang, coalesce(text, '') || {PLANT} AS text FROM documents)"
LINES = lines()
TYPE = f"""CASE WHEN line = '' THEN 'blank' WHEN regexp_matches(line, {q(P.FOOTER_NUMBER)}) THEN 'footer'
  WHEN {isin('lower(line)', P.HEADER_PHRASES)} THEN 'header'
  WHEN {rx('line', P.HEADINGS)} THEN 'heading' WHEN regexp_matches(text, {q(P.LIST_ITEM)}) THEN 'list_item'
  WHEN length(line) < 60 AND regexp_matches(line, '^[A-Z0-9#]') AND NOT regexp_matches(line, '[.!?:,;]$') THEN 'heading' ELSE 'paragraph' END"""
TYPED = f"{LINES}, typed AS (SELECT *, {TYPE} AS type FROM lines)"
BOX = """SELECT *, y0 + 12 AS y1, CASE WHEN length(text) % 5 = 0 THEN x0 + 540 ELSE x0 + 60 + length(text) % 180 END AS x1 FROM (SELECT *,
  CASE WHEN length(text) % 5 = 0 THEN 20 WHEN seq % 2 = 0 THEN 40 ELSE 320 END AS x0, 840 - (seq % 42) * 20 AS y0 FROM lines)"""
BOXED = f"{LINES}, boxed AS ({BOX})"
LAYOUT = f"""{lines(PLANTED)}, layout AS (SELECT * REPLACE (CASE WHEN text LIKE 'Which of%' THEN 30 ELSE y0 END AS y0),
  CASE WHEN regexp_matches(text, '^(Which of|\\(a\\) the|1\\.2 S)') THEN 'footer' WHEN text LIKE 'Figure %' THEN 'caption' ELSE {TYPE} END AS type
      FROM ({BOX}))"""
TOP_WORDS = " OR ".join(f"contains(lower(line), {q(w)})" for w in P.TOP_MARGIN_WORDS)
TAG = f"""CASE WHEN line = '' THEN NULL WHEN {rx('line', P.EXERCISE)} THEN 'exercise_heading' WHEN {rx('line', P.BIBLIOGRAPHY)} THEN 'bibliography'
  WHEN {rx('line', P.FOOTER)} THEN 'footer' WHEN {rx('line', P.HEADER)} THEN 'header'
  WHEN y0 > 842 * 0.93 AND length(line) < 80 AND ({TOP_WORDS}) THEN 'header' WHEN y0 < 842 * 0.07 AND length(line) < 60 THEN 'footer'
  WHEN {rx('line', P.COPYRIGHT)} THEN 'copyright' WHEN {rx('line', P.TOC)} THEN 'toc' WHEN {rx('line', P.WATERMARK)} THEN 'watermark' END"""
REPEATING = """repeating AS (SELECT file_id, line, count(DISTINCT page_num) AS pages FROM lines
  WHERE length(line) > 0 AND length(line) < 120 GROUP BY ALL HAVING count(DISTINCT page_num) >= 3)"""
TOC_HITS = " + ".join(f"CAST(contains(lower(text), {q(w)}) AS INTEGER)" for w in P.TOC_WORDS)
#: The four passes of boilerplate: by pattern and place, by repetition, types, page numbers of tables of contents.
PASSES = f"""{LAYOUT}, {REPEATING}, one AS (SELECT * REPLACE (CASE WHEN c = 'exercise_heading' THEN c ELSE type END AS type) FROM (SELECT *,
      {TAG} AS c FROM layout)),
  two AS (SELECT o.* EXCLUDE (c), coalesce(o.c, CASE WHEN r.line IS NOT NULL THEN 'repeating_header_footer' END) AS bt
    FROM one o LEFT JOIN repeating r ON o.file_id = r.file_id AND o.line = r.line),
  tagged AS (SELECT *, bt IS NOT NULL AND bt NOT IN ('exercise_heading', 'bibliography') AS bp FROM two),
  three AS (SELECT * REPLACE (CASE WHEN bp AND bt IN ('header', 'repeating_header_footer') THEN 'header' WHEN bp AND bt = 'footer' THEN 'footer'
      ELSE type END AS type) FROM tagged),
  tocs AS (SELECT DISTINCT file_id, page_num FROM three WHERE type = 'paragraph' AND length(lower(text)) > 200 AND {TOC_HITS} >= 3),
  four AS (SELECT *, bp AND regexp_matches(line, '^[0-9]{{1,4}}$') AND (file_id, page_num) IN (SELECT (file_id, page_num) FROM tocs) AS num
      FROM three),
  passed AS (SELECT * EXCLUDE (bt, bp, num, type), bp AS is_boilerplate, CASE WHEN num THEN 'toc_page_number' ELSE bt END AS boilerplate_type,
    CASE WHEN num THEN 'toc_page_number' ELSE type END AS type FROM four),
  headed AS (SELECT * REPLACE (CASE WHEN was_corrected THEN 'heading' ELSE type END AS type) FROM (SELECT *,
    coalesce(NOT is_boilerplate AND type = 'footer' AND regexp_matches(line, {q(P.NUMBERED_HEADING)}) AND length(line) < 80, false) AS was_corrected
      FROM passed)),
  done AS (SELECT * EXCLUDE (fix) REPLACE (CASE WHEN fix THEN 'pyq_question' ELSE type END AS type, is_boilerplate AND NOT fix AS is_boilerplate,
      was_corrected OR fix AS was_corrected)
    FROM (SELECT *, coalesce(is_boilerplate AND type = 'footer' AND regexp_matches(line, {q(P.QUESTION_OPENERS)}), false) AS fix FROM headed))"""
PART = lambda c, n: f"(CAST('0x' || substr(md5({c}), 1, 8) AS BIGINT) % {n})"
TABLES = """grouped AS (SELECT file_id, page_num, doc_id, list(string_split(text, ' | ') ORDER BY seq) AS a FROM LINES WHERE contains(text, ' | ')
      GROUP BY 1, 2, 3),
  tab AS (SELECT file_id, page_num, doc_id, a[1] AS headers, a[2:] AS rows FROM grouped)"""
TAB = f"plain AS (SELECT * FROM {lines().removeprefix('lines AS ')}), {TABLES.replace('LINES', 'plain')}"
EXPECTED = f"expected AS (SELECT file_id, CAST(max(page_num) + CASE WHEN {PART('max(file_id)', 3)} = 0 THEN 1 ELSE 0 END AS INTEGER) AS expected FROM plain GROUP BY file_id)"
#: frame: the blocks that an extraction kept.
COVERED = """seen AS (SELECT file_id, list_distinct(list(page_num)) AS seen FROM (SELECT file_id, page_num FROM FRAME UNION ALL SELECT file_id,
      page_num FROM tab) GROUP BY 1),
  covered AS (SELECT e.file_id, expected, CAST(len(coalesce(seen, [])) AS INTEGER) AS covered,
    array_to_string(list_filter(range(1, expected + 1), lambda x: NOT list_contains(coalesce(seen, []), x)), ',') AS missing_pages,
    ROUNDED AS coverage_pct FROM expected e LEFT
      JOIN seen USING (file_id))""".replace("ROUNDED", rounded("100 * len(coalesce(seen, [])) / expected", 2))
STATS = """SELECT file_id, page_num, CAST(sum(length(text)) AS BIGINT) AS chars, count(*) FILTER (NOT is_boilerplate) AS content_blocks,
  CAST(coalesce(max(length(text)) FILTER (NOT is_boilerplate), 0) AS INTEGER) AS longest FROM FRAME GROUP BY 1, 2"""
_W = "OVER (PARTITION BY file_id, page_num ORDER BY doc_id, seq)"
_F = "OVER (PARTITION BY file_id ORDER BY page_num, doc_id, seq)"
UNMERGED = f"""(SELECT file_id, count(*) FILTER (split) AS unmerged FROM (SELECT file_id, type = 'paragraph' AND NOT is_boilerplate
      AND lead(type = 'paragraph' AND NOT is_boilerplate) {_F}
  AND line <> '' AND NOT regexp_matches(line, {q(P.SPLIT_END)}) AND regexp_matches(lead(line) {_F}, '^[a-z]') AS split FROM FRAME) GROUP BY 1)"""
STYLIZED = "text"
for _a, _b in P.STYLIZED_HEADINGS:
    STYLIZED = f"regexp_replace({STYLIZED}, {q(_a)}, {q(_b)}, 'g')"
CONTAMINATED = """SELECT file_id, count(*) AS duplicates FROM (SELECT file_id, line FROM FRAME WHERE length(line) > 40 GROUP BY 1, 2
      HAVING count(DISTINCT page_num) > 1) GROUP BY 1"""
WIDTHS = "wide AS (SELECT DISTINCT file_id, page_num, CAST(CASE WHEN page_num % 2 = 0 THEN 595 + page_num % 5 ELSE 612 END AS DOUBLE) AS w FROM lines)"
MIDPOINT = f"""{BOXED}, {WIDTHS}, e AS (SELECT DISTINCT file_id, page_num, x0, w FROM boxed JOIN wide USING (file_id, page_num)
      WHERE x1 - x0 <= 0.7 * w),
  g AS (SELECT *, lead(x0) OVER (PARTITION BY file_id, page_num ORDER BY x0) AS nxt, count(*) OVER (PARTITION BY file_id, page_num) AS n FROM e),
  b AS (SELECT file_id, page_num, (x0 + nxt) / 2 AS mid FROM g WHERE n >= 4 AND nxt - x0 >= 15 AND (x0 + nxt) / 2 BETWEEN 0.3 * w AND 0.7 * w
    QUALIFY row_number() OVER (PARTITION BY file_id, page_num ORDER BY nxt - x0 DESC, x0) = 1),
  mids AS (SELECT p.file_id, p.page_num, p.w, CAST(coalesce(b.mid, p.w / 2) AS DOUBLE) AS mid FROM wide p LEFT JOIN b USING (file_id, page_num))"""
RECOGNISED = f"""{lines(PLANTED)}, seen AS (SELECT file_id, page_num, seq AS line_no, line AS text, CASE WHEN seq % 2 = 0 THEN 250 ELSE 750 END AS xc,
  60 + (seq * 37) % 1300 AS yc FROM lines WHERE line <> '')"""


def islands(by: str, place: str, broken: str) -> str:
    """CTEs from a frame `kinds` (kind null for plain lines): runs of plain lines become paragraphs."""
    w = f"OVER (PARTITION BY {by} ORDER BY {place})"
    return f"""marks AS (SELECT *, kind IS NOT NULL OR lag(kind) {w} IS NOT NULL OR lag({place}) {w} IS NULL OR coalesce({broken}, false) AS fresh
      FROM kinds),
      runs AS (SELECT *, CAST(sum(CAST(fresh AS INTEGER)) {w} AS INTEGER) AS n FROM marks)
      SELECT {by}, n AS place, coalesce(max(kind), 'paragraph') AS type, string_agg(text, ' ' ORDER BY {place}) AS text FROM runs GROUP BY {by}, n"""


_C = "OVER (PARTITION BY file_id, page_num, \"column\" ORDER BY line_no)"
_HIGH = f"greatest(lag(max_y) {_C} - lag(min_y) {_C}, 10)"
_GAP = f"(min_y - lag(max_y) {_C})"
_ENDS = f"regexp_matches(lag(text) {_C}, {q(P.LINE_END)}) AND regexp_matches(text, {q('^[A-Z\"’]')})"
_BROKEN = f"{_GAP} > 1.35 * {_HIGH} OR min_x > lag(min_x) {_C} + 14 OR ({_ENDS} AND {_GAP} > 0.5 * {_HIGH})"

ORACLE_SQL |= {
    "block_summary": f"""WITH {PASSES}, {TAB} SELECT d.*, coalesce(t.n, 0) AS table_count, coalesce(i.n, 0) AS image_count FROM (SELECT file_id, count(*) AS total_blocks,
      count(*) FILTER (NOT is_boilerplate) AS content_blocks,
      count(*) FILTER (is_boilerplate) AS boilerplate_blocks, count(*) FILTER (was_corrected) AS corrected_blocks,
      CAST(sum(length(text)) AS BIGINT) AS chars FROM done GROUP BY 1) d
      LEFT JOIN (SELECT file_id, count(*) AS n FROM tab GROUP BY 1) t USING (file_id)
      LEFT JOIN (SELECT file_id, count(*) AS n FROM (SELECT concat(source, '-', doc_id // 2000) AS file_id, length(coalesce(text, '')) AS n FROM documents)
        WHERE n % 150 NOT BETWEEN 1 AND 59 AND n % 97 NOT BETWEEN 1 AND 59 AND n * 10 >= 3000 GROUP BY 1) i USING (file_id)""",
    "page_stats": f"WITH {PASSES} {STATS.replace('FRAME', 'done')}",
    "blob_pages": f"WITH {PASSES}, s AS ({STATS.replace('FRAME', 'done')}) SELECT * FROM s WHERE content_blocks <= 3 AND longest > 400",
    "content_blocks": f"WITH {PASSES} SELECT doc_id, seq, type, line AS text FROM done WHERE NOT is_boilerplate AND line <> ''",
    "type_counts": f"WITH {TYPED} SELECT file_id, type, count(*) AS n FROM typed GROUP BY 1, 2",
    "repeating_lines": f"WITH {LINES}, {REPEATING} SELECT * FROM repeating",
    "contamination": f"WITH {LINES} {CONTAMINATED.replace('FRAME', 'lines')}",
    "coverage": f"""WITH {TAB}, {EXPECTED}, kept AS (SELECT * FROM plain WHERE page_num % 7 <> 3), {COVERED.replace('FRAME', 'kept')} SELECT *
      FROM covered""",
    "missing_pages": f"""WITH {TAB}, {EXPECTED}, e AS (SELECT file_id, CAST(unnest(range(1, expected + 1)) AS INTEGER) AS page_num FROM expected)
      SELECT file_id, page_num FROM e WHERE (file_id, page_num) NOT IN (SELECT (file_id, page_num) FROM plain WHERE page_num % 7 <> 3) AND (file_id,
      page_num) NOT IN (SELECT (file_id, page_num) FROM tab)""",
    "recovery_pages": f"""WITH {PASSES}, {TAB}, {EXPECTED}, e AS (SELECT file_id, CAST(unnest(range(1, expected + 1)) AS INTEGER) AS page_num
      FROM expected),
      kept AS (SELECT * FROM done WHERE page_num % 7 <> 3), s AS ({STATS.replace('FRAME', 'kept')}),
      f AS (SELECT e.file_id, e.page_num, s.chars IS NULL AS missing, coalesce(s.chars, 0) < 20 AS low, coalesce(s.content_blocks <= 3
      AND s.longest > 400, false) AS blob FROM e LEFT JOIN s USING (file_id, page_num))
      SELECT * FROM f WHERE missing OR low OR blob""",
    "replaced_pages": f"""WITH {LINES}, p AS (SELECT file_id, page_num, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS c,
      count(DISTINCT doc_id) AS docs FROM lines GROUP BY 1, 2),
      longest AS (SELECT file_id, page_num, max(m) AS m FROM (SELECT file_id, page_num, doc_id, sum(length(text)) + count(*) - 1 AS m FROM lines
      GROUP BY 1, 2, 3) GROUP BY 1, 2)
      SELECT file_id, page_num, CASE WHEN docs <= 3 AND m > 400 AND n > 1 THEN 'recovered' ELSE 'flat' END AS origin, CASE WHEN docs <= 3 AND m > 400
      AND n > 1 THEN n ELSE docs END AS n,
      CASE WHEN docs <= 3 AND m > 400 AND n > 1 THEN c ELSE c + n - docs END AS chars FROM p JOIN longest USING (file_id, page_num)""",
    "page_paragraphs": f"""WITH t AS (SELECT doc_id, CAST(doc_id % 2000 // 20 + 1 AS INTEGER) AS page_num, CASE
      WHEN doc_id % 9 = 0 THEN ' ' || chr(10) ELSE regexp_replace(text, '[.]\\n', '.' || chr(10) || chr(10), 'g') END AS text FROM documents
      WHERE text IS NOT NULL),
      u AS (SELECT doc_id, page_num, CASE WHEN {strip('text')} = '' THEN format('[Empty Page: Page {{}} has no text or image content]', page_num)
      ELSE {strip('text')} END AS text FROM t),
      v AS (SELECT doc_id, page_num, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {strip('x')}),
      lambda x: x <> '') AS a FROM u)
      SELECT doc_id, part, format('blk_fallback_p{{:04d}}_{{:03d}}', page_num, part) AS block_id, text FROM (SELECT doc_id, page_num,
      CAST(generate_subscripts(a, 1) AS INTEGER) AS part, unnest(a) AS text FROM v)""",
    "noise_filter": f"""WITH {LAYOUT} SELECT doc_id, seq, type, text FROM layout WHERE line <> '' AND NOT {isin('lower(line)', P.GARBAGE_TOKENS)}
      AND NOT (regexp_matches(line, {q(P.SINGLE_MARK)}) AND type IN ('paragraph', 'footer')) AND NOT regexp_matches(line, {q(P.YEAR_MARK)})""",
    "boilerplate_tag": f"WITH {PASSES} SELECT doc_id, seq, type, boilerplate_type, is_boilerplate FROM passed",
    "boilerplate_counts": f"""WITH {PASSES} SELECT boilerplate_type, type, count(*) AS n, count(*) FILTER (is_boilerplate) AS boilerplate FROM passed
      GROUP BY 1, 2""",
    "heading_rescue": f"WITH {PASSES} SELECT file_id, type, was_corrected, count(*) AS n FROM headed GROUP BY 1, 2, 3",
    "pyq_rescue": f"""WITH {PASSES}, fixed AS (SELECT *, coalesce(is_boilerplate AND type = 'footer' AND regexp_matches(line,
      {q(P.QUESTION_OPENERS)}), false) AS fix FROM passed)
      SELECT file_id, CASE WHEN fix THEN 'pyq_question' ELSE type END AS type, is_boilerplate AND NOT fix AS is_boilerplate, boilerplate_type,
      fix AS was_corrected, count(*) AS n FROM fixed GROUP BY ALL""",
    "mojibake": f"""WITH {PASSES} SELECT doc_id, seq, length(regexp_replace(text, '[\\x20-\\x7E]', '', 'g')) / length(text) >= 0.3 AS encoding_error
      FROM passed
      WHERE is_boilerplate AND length(text) > 0""",
    "toc_pages": f"WITH {PASSES} SELECT file_id, page_num FROM tocs",
    "stylized_headings": f"""WITH {LAYOUT} SELECT doc_id, seq, CASE WHEN {rx('text', [p for p, _ in P.STYLIZED_HEADINGS])} THEN 'heading'
      ELSE 'paragraph' END AS type, {STYLIZED} AS text FROM layout""",
    "label_types": """SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'heading' WHEN 1 THEN 'list_item' WHEN 2 THEN 'caption' WHEN 3 THEN 'footnote'
      WHEN 4 THEN 'header'
      WHEN 5 THEN 'footer' ELSE 'paragraph' END AS type FROM documents""",
    "font_types": f"""WITH {LAYOUT}, f AS (SELECT doc_id, seq, text, 842 - y0 AS y, length(text) % 3 = 0 AS large FROM layout)
      SELECT doc_id, seq, CASE WHEN y > 842 * 0.93 THEN 'footer' WHEN y < 842 * 0.06 THEN 'header' WHEN large AND length(text) < 100 THEN 'heading'
      WHEN regexp_matches(text, {q(P.FONT_LIST_ITEM)}) THEN 'list_item' ELSE 'paragraph' END AS first,
      CASE WHEN y > 842 * 0.93 THEN 'footer' WHEN y < 842 * 0.07 THEN 'header' WHEN large AND length(text) < 120 THEN 'heading'
      WHEN regexp_matches(text, {q(P.FONT_LIST_ITEM_MORE)}) THEN 'list_item' ELSE 'paragraph' END AS second FROM f""",
    "highlight_colors": """SELECT doc_id, CASE WHEN r >= 230 AND g >= 230 AND b >= 230 THEN NULL WHEN r > 200 AND b > 150 AND r - g > 20
      AND b - g > 10 THEN 'pink_callout'
      WHEN r > 200 AND g > 180 AND b < 150 AND r - b > 60 THEN 'yellow_callout' WHEN b > 180 AND b - r > 30
      AND b - g > 20 THEN 'blue_callout' END AS highlight
      FROM (SELECT doc_id, doc_id % 10 * 28 + 3 AS r, doc_id // 10 % 10 * 28 + 3 AS g, doc_id // 100 % 10 * 28 + 3 AS b FROM documents)""",
    "block_background": f"""WITH {BOXED}, few AS (SELECT * FROM boxed), spots AS (SELECT file_id, page_num, x0 * 2 - 5 - k AS x,
      1684 - (y0 + 6) * 2 AS y, (length(text) * 7 + k * 40) % 256 AS r,
        (length(text) * 11 + k * 40) % 256 AS g, (length(text) * 13 + k * 40) % 256 AS b FROM few, range(3) t(k)),
      c AS (SELECT f.doc_id, f.seq, CAST(floor(median(s.r)) AS INTEGER) AS r, CAST(floor(median(s.g)) AS INTEGER) AS g,
      CAST(floor(median(s.b)) AS INTEGER) AS b FROM few f JOIN spots s
        ON f.file_id = s.file_id AND f.page_num = s.page_num AND s.x >= 2 * f.x0 - 15 AND s.x < 2 * f.x0 - 2 AND s.y >= greatest(1684 - 2 * f.y1, 0)
      AND s.y < least(1684 - 2 * f.y0, 1684) GROUP BY 1, 2)
      SELECT *, CASE WHEN r >= 230 AND g >= 230 AND b >= 230 THEN NULL WHEN r > 200 AND b > 150 AND r - g > 20 AND b - g > 10 THEN 'pink_callout'
      WHEN r > 200 AND g > 180 AND b < 150 AND r - b > 60 THEN 'yellow_callout' WHEN b > 180 AND b - r > 30
      AND b - g > 20 THEN 'blue_callout' END AS highlight FROM c""",
    "placeholder_boxes": f"""WITH {LINES} SELECT file_id, count(*) FILTER (length(text) % 10 = 0) AS placeholders, count(*) AS blocks FROM lines
      GROUP BY 1""",
    "page_figures": """WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS n FROM documents), i AS (SELECT doc_id,
      CAST(n % 150 AS INTEGER) AS width, CAST(n % 97 AS INTEGER) AS height, CAST(n * 10 AS INTEGER) AS bytes FROM n)
      SELECT * FROM i WHERE NOT (width > 0 AND width < 60) AND NOT (height > 0 AND height < 60) AND bytes >= 3000""",
    "llm_summaries": f"""WITH {lines(PLANTED)} SELECT file_id, page_num FROM lines GROUP BY 1, 2
      HAVING bool_or({' OR '.join(f"contains(lower(text), {q(w)})" for w in P.SUMMARY_PHRASES)}) OR (count(*) <= 2 AND bool_or(regexp_matches(text,
      {q(P.SUMMARY_BULLETS)})))""",
    "blank_page_check": f"""WITH {TAB} SELECT DISTINCT file_id, page_num, CASE WHEN page_num % 2 = 0 THEN 'blank_page' ELSE 'paragraph' END AS type
      FROM plain p
      WHERE page_num % 2 = 1 OR (file_id, page_num) NOT IN (SELECT (file_id, page_num) FROM tab)""",
    "page_range": f"WITH {LINES} SELECT file_id, page_num, count(*) AS n FROM lines WHERE page_num BETWEEN 2 AND 3 GROUP BY 1, 2",
    "patched_order": f"""WITH {LINES}, i AS (SELECT *, format('blk_{{:04d}}', row_number() OVER (PARTITION BY file_id ORDER BY page_num, doc_id,
      seq)) AS block_id FROM lines)
      SELECT doc_id, seq, CAST(row_number() OVER (PARTITION BY file_id ORDER BY page_num, block_id, doc_id, seq) AS INTEGER) AS position FROM i""",
    "page_texts": f"""WITH {PASSES} SELECT file_id, page_num, coalesce(string_agg(text, ' ' ORDER BY doc_id, seq) FILTER (NOT is_boilerplate
      AND type NOT IN ('header', 'footer')), '') AS text FROM done GROUP BY 1, 2""",
    "block_ids": f"""WITH {LINES} SELECT doc_id, seq, format('blk_{{:04d}}', row_number() OVER (PARTITION BY file_id ORDER BY page_num, doc_id,
      seq)) AS block_id FROM lines""",
    "reading_order": f"""WITH {LAYOUT}, lost AS (SELECT * REPLACE (CASE WHEN boxed THEN x0 END AS x0, CASE WHEN boxed THEN x1 END AS x1, CASE
      WHEN boxed THEN y0 END AS y0) FROM (SELECT *, length(text) % 17 <> 3 AS boxed FROM layout)),
      e AS (SELECT *, min(x0) OVER p AS low, greatest(max(x1) OVER p - min(x0) OVER p, 100) AS wide FROM lost WINDOW p AS (PARTITION BY file_id,
      page_num)),
      s AS (SELECT *, coalesce((x1 - x0) / wide < 0.5, false) AS narrow, coalesce((x0 + x1) / 2 < low + wide / 2, false) AS lft FROM e),
      c AS (SELECT *, count(*) FILTER (narrow AND lft) OVER p >= 4 AND count(*) FILTER (narrow AND NOT lft) OVER p >= 4
      AND count(*) FILTER (narrow) OVER p > 0.6 * count(*) FILTER (boxed) OVER p AS cols
        FROM s WINDOW p AS (PARTITION BY file_id, page_num)),
      z AS (SELECT *, CASE WHEN NOT boxed THEN 9 WHEN NOT cols THEN 0 WHEN type = 'header' THEN 0 WHEN type = 'footer' THEN 3 WHEN lft THEN 1
      ELSE 2 END AS zone FROM c)
      SELECT doc_id, seq, CAST(row_number() OVER (PARTITION BY file_id, page_num ORDER BY zone, -round_even(y0 / 6, 0) * 6 NULLS FIRST,
      x0 NULLS FIRST, doc_id, seq) AS INTEGER) AS position FROM z""",
    "page_extents": f"""WITH {BOXED} SELECT file_id, page_num, min(x0) AS min_x, max(x1) AS max_x, greatest(max(x1) - min(x0), 100) AS width
      FROM boxed GROUP BY 1, 2""",
    "column_midpoint": f"WITH {MIDPOINT} SELECT file_id, page_num, mid FROM mids",
    "page_reorder": f"""WITH {MIDPOINT}, a AS (SELECT *, x1 - x0 > 0.7 * w AS anchor FROM boxed JOIN mids USING (file_id, page_num)),
      s AS (SELECT *, sum(CAST(anchor AS INTEGER)) OVER (PARTITION BY file_id, page_num ORDER BY y0 DESC, doc_id,
      seq ROWS UNBOUNDED PRECEDING) AS seg,
      CASE WHEN anchor THEN -1 WHEN x0 < mid - 5 THEN 0 ELSE 1 END AS side FROM a)
      SELECT doc_id, seq, CAST(row_number() OVER (PARTITION BY file_id, page_num ORDER BY seg, side, y0 DESC, doc_id, seq) AS INTEGER) AS position
      FROM s""",
    "normalize_text": f"WITH {LINES} SELECT doc_id, seq, {norm('text')} AS text FROM lines",
    "consecutive_dedup": f"""WITH {LAYOUT}, f AS (SELECT *, left({norm("nfc_normalize(replace(text, 'ﬁ', 'fi'))")}, 120) AS fp FROM layout)
      SELECT doc_id, seq, text FROM f QUALIFY lag(fp) {_W} IS DISTINCT FROM fp""",
    "heading_dedup": f"""WITH {LAYOUT} SELECT doc_id, seq, text FROM layout QUALIFY NOT (type = 'heading' AND coalesce(lag(type) {_W} = 'heading'
      AND lower(line) = lag(lower(line)) {_W}, false))""",
    "unmerged_splits": f"WITH {PASSES} SELECT * FROM {UNMERGED.replace('FRAME', 'done')}",
    "callout_runs": f"""WITH {LINES}, h AS (SELECT *, CASE length(text) % 4 WHEN 0 THEN 'pink_callout'
      WHEN 1 THEN 'blue_callout' END AS highlight_type FROM lines),
      s AS (SELECT *, highlight_type IS NOT NULL AND highlight_type IS DISTINCT FROM lag(highlight_type) {_W} AS start FROM h), n AS (SELECT *,
      sum(CAST(start AS INTEGER)) {_W} AS k FROM s)
      SELECT doc_id, seq, highlight_type, CASE WHEN highlight_type IS NOT NULL THEN format('box_p{{}}_{{:03d}}', page_num,
      CAST(k AS BIGINT)) END AS box_id FROM n""",
    "blank_markers": f"""WITH {PASSES} SELECT file_id, page_num, 'blank_page' AS type, '' AS text FROM done GROUP BY 1, 2
      HAVING bool_and(is_boilerplate OR length(text) < 60 OR type IN ('header', 'footer', 'toc_page_number'))""",
    "line_zones": f"""WITH {RECOGNISED}, z AS (SELECT *, CASE WHEN yc < 112 OR {isin('lower(text)', P.HEADER_PHRASES)} THEN 'header' WHEN yc > 1288
      OR (regexp_matches(text, {q(P.FOOTER_NUMBER)}) AND length(text) <= 3) THEN 'footer'
        WHEN xc < 500 THEN 'left' ELSE 'right' END AS zone FROM seen),
      kinds AS (SELECT file_id, page_num, text, CASE WHEN zone IN ('header', 'footer') THEN zone WHEN {rx('text', P.LINE_HEADINGS)} THEN 'heading'
      WHEN regexp_matches(text, {q(P.LIST_ITEM)}) THEN 'list_item' END AS kind,
        row_number() OVER (PARTITION BY file_id, page_num ORDER BY list_position(['header', 'left', 'right', 'footer'], zone), CASE
      WHEN zone IN ('left', 'right') THEN yc END NULLS FIRST, line_no) AS k FROM z),
      {islands('file_id, page_num', 'k', 'false')}""",
    "paragraph_breaks": f"""WITH {RECOGNISED}, kinds AS (SELECT file_id, page_num, 1 AS "column", line_no, text, CASE
      WHEN length(text) % 7 = 0 THEN 60 ELSE 40 END AS min_x, line_no * 30.0 AS min_y, line_no * 30.0 + 18 - length(text) % 3 * 6 AS max_y,
        CASE WHEN {rx('text', P.HEADINGS)} THEN 'heading' WHEN regexp_matches(text, {q(P.LIST_ITEM)}) THEN 'list_item' END AS kind FROM seen),
      {islands('file_id, page_num, "column"', 'line_no', _BROKEN)}""",
    "upsert": """WITH n AS (SELECT doc_id FROM labels WHERE doc_id % 2 = 0), m AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM n UNION ALL
      SELECT -doc_id - 1 FROM n))
      SELECT doc_id, lang, 'old' AS version FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM m) UNION ALL SELECT doc_id, 'x', 'new' FROM m""",
    "status_update": """SELECT d.doc_id, CASE WHEN l.quality = 0 THEN 'failed' ELSE 'registered' END AS status, CASE
      WHEN l.quality = 0 THEN 'low quality' END AS error
      FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "latest_status": """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
      arg_max(value, event_id) FILTER (event_id % 3 = 0 AND value IS NOT NULL) AS value FROM events GROUP BY 1""",
    "upload_intake": """WITH u AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'History' WHEN 'de' THEN 'Anthropology' ELSE lang END AS c FROM documents),
      e AS (SELECT *, CASE WHEN c NOT IN ('History', 'Anthropology') THEN 'classification' WHEN doc_id % 7 = 0 THEN 'extension' END AS error FROM u)
      SELECT doc_id, error, CASE WHEN error IS NULL THEN 'uploads/' || lower(c) || '/' || doc_id || '.pdf' END AS path, CASE c
      WHEN 'History' THEN 'history_chunks' WHEN 'Anthropology' THEN 'anthropology_chunks' END AS collection FROM e""",
    "registry_response": """SELECT event_id AS document_id, event_type AS status, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created_at, strftime(ts,
      '%Y-%m-%dT%H:%M:%S') AS updated_at FROM events""",
    "batch_progress": """SELECT path, format('[{}/{}]', row_number() OVER (ORDER BY path), count(*) OVER ()) AS label
      FROM (SELECT source || '/' || doc_id || '.pdf' AS path FROM documents)""",
    "status_funnel": """SELECT CASE WHEN quality IS NULL THEN 'registered' WHEN quality = 0 THEN 'failed' WHEN toxic = 1 THEN 'extracted'
      ELSE 'ingested' END AS status, count(*) AS n
      FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
    "html_blocks": f"""WITH m AS (SELECT page_id, string_split(regexp_replace(html, {q(BLOCK_TAG)}, chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS a
      FROM pages),
      p AS (SELECT page_id, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS seq, unnest(a) AS part FROM m),
      t AS (SELECT page_id, seq, lower(regexp_extract(part, '^([A-Za-z0-9]+)\\x02', 1)) AS tag,
      trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(part, '^[^\\x02]*\\x02', ''), {q(SPACE_TAG)}, ' ', 'g'), '<[^<>]*>', '', 'g'),
      '[ \\t\\r\\n]+', ' ', 'g')) AS text
      FROM p)
      SELECT page_id, seq, CASE tag WHEN 'h1' THEN 'heading' WHEN 'p' THEN 'paragraph' WHEN 'li' THEN 'list_item' WHEN 'nav' THEN 'header'
      WHEN 'footer' THEN 'footer' END AS type, text
      FROM t WHERE tag IN ('h1', 'p', 'li', 'nav', 'footer') AND text <> ''""",
}


def greedy(frame: str, links: str, by: str, order: str) -> str:
    """CTEs that add joins and taken to a frame: of a run of links those at odd places join."""
    w = f"PARTITION BY {by} ORDER BY {order}"
    return f"""linked AS (SELECT *, coalesce({links}, false) AS links, lead(line) OVER ({w}) AS next_line FROM {frame}),
      runs AS (SELECT *, coalesce(sum(CASE WHEN links THEN 0 ELSE 1 END) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run
      FROM linked),
      odd AS (SELECT *, links AND row_number() OVER (PARTITION BY {by}, run ORDER BY {order}) % 2 = 1 AS joins FROM runs),
      paired AS (SELECT *, coalesce(lag(joins) OVER ({w}), false) AS taken FROM odd)"""


_LINKS = f"""type = 'paragraph' AND lead(type) {_F} = 'paragraph' AND lead(page_num) {_F} = page_num + 1 AND rtext <> '' AND NOT regexp_matches(rtext,
      {q(P.SENTENCE_END)})
  AND lead(ltext) {_F} <> '' AND NOT regexp_matches(lead(ltext) {_F}, '^[A-Z‘“]')"""
_BLANKS = "[\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+"
ORACLE_SQL |= {
    "caption_join": f"""WITH {LAYOUT}, cap AS (SELECT * FROM layout),
      {greedy('cap', f"type = 'caption' AND lead(type) {_W} = 'caption' AND NOT regexp_matches(line, '[.?!]$')", 'file_id, page_num', 'doc_id, seq')}
      SELECT doc_id, seq, type, CASE WHEN joins THEN line || ' ' || next_line ELSE text END AS text FROM paired WHERE NOT taken""",
    "cross_page_merge": f"""WITH {PASSES}, own AS (SELECT *, regexp_replace(text, '{_BLANKS}$', '') AS rtext, regexp_replace(text, '^{_BLANKS}',
      '') AS ltext FROM done WHERE NOT is_boilerplate),
      {greedy('own', _LINKS, 'file_id', 'page_num, doc_id, seq').replace('lead(line)', 'lead(ltext)')}
      SELECT doc_id, seq, CASE WHEN joins THEN rtext || ' ' || next_line ELSE text END AS text, was_corrected OR joins AS was_corrected FROM paired
      WHERE NOT taken
      UNION ALL SELECT doc_id, seq, text, was_corrected FROM done WHERE is_boilerplate""",
    "page_dedup": f"""WITH pg AS (SELECT lang || '/' || CAST(doc_id // 1000 AS VARCHAR) AS file_id, doc_id AS page_num,
      {norm("coalesce(text, '')")} AS low FROM documents),
      r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY page_num) AS rn, list_distinct(string_split(low, ' ')) AS w FROM pg)
      SELECT file_id, page_num FROM r a WHERE NOT EXISTS (SELECT 1 FROM r b WHERE b.file_id = a.file_id AND b.rn BETWEEN a.rn - 4 AND a.rn - 1
      AND length(a.low) >= 60 AND length(b.low) >= 60
      AND len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) >= CASE
      WHEN {' OR '.join(f"contains(a.low, {q(w)})" for w in P.SAME_TOPIC_WORDS)} THEN 0.5 ELSE 0.8 END)""",
    "covered_blocks": f"""WITH {BOXED}, d AS (SELECT file_id, page_num, x0 AS a0, y0 - 20 AS b0, x0 + CASE WHEN seq % 15 = 0 THEN 600
      ELSE 200 END AS a1, y1 + CASE WHEN seq % 15 = 0 THEN 60 ELSE 1 END AS b1 FROM boxed WHERE seq % 10 = 0),
      r AS (SELECT * FROM d WHERE (a1 - a0) * (b1 - b0) < 0.05 * CASE WHEN page_num % 2 = 0 THEN 595 ELSE 612 END * 842)
      SELECT doc_id, seq FROM boxed b WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.file_id = b.file_id AND r.page_num = b.page_num
      AND greatest(least(b.x1, a1) - greatest(b.x0, a0), 0) * greatest(least(b.y1, b1) - greatest(b.y0, b0),
      0) > 0.85 * (b.x1 - b.x0) * (b.y1 - b.y0))""",
    "split_collapsed": f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'caption' ELSE 'paragraph' END AS type, text FROM documents),
      l AS (SELECT doc_id, part, n, line, CASE WHEN {isin('lower(line)', P.HEADER_PHRASES)} THEN 'header' WHEN regexp_matches(line,
      {q(P.FOOTER_NUMBER)}) AND length(line) <= 3 THEN 'footer'
      WHEN {rx('line', P.HEADINGS)} THEN 'heading' WHEN regexp_matches(line, {q(P.LIST_ITEM)}) THEN 'list_item' END AS type FROM (SELECT doc_id,
      CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS part, CAST(len(a) AS INTEGER) AS n, {strip('unnest(a)')} AS line
      FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM d WHERE type = 'paragraph' AND length(text) > 400 AND contains(text, chr(10))))
      WHERE line <> '')
      SELECT doc_id, part, type, line AS text FROM l WHERE type IS NOT NULL UNION ALL SELECT doc_id, max(n), 'paragraph', string_agg(line,
      ' ' ORDER BY part) FROM l WHERE type IS NULL GROUP BY doc_id
      UNION ALL SELECT doc_id, -1, type, text FROM d WHERE NOT coalesce(type = 'paragraph' AND length(text) > 400 AND contains(text, chr(10)),
      false)""",
}


def chain(c: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        c = f"regexp_replace({c}, {q(a)}, {q(b)}, 'g')"
    return c


#: Letters beyond ASCII stand as numbers between underscores while words are corrected: to this engine's word
#: boundaries they would else be no part of words.
FOREIGN = "ßàáâãäåæçèéêëìîïðñòóôõöøùúûüýÿÀÁÂÃÄÅÆÇÈÉÊËÌÎÏÐÑÒÓÔÕÖØÙÚÛÜÝœŒ"


def corrected(c: str) -> str:
    for a, b in P.CHARACTERS:
        c = f"replace({c}, {q(a)}, {q(b)})"
    for k, letter in enumerate(FOREIGN):
        c = f"replace({c}, '{letter}', '_9{k:03d}_')"
    c = f"regexp_replace({c}, {q(P.HYPHEN_BREAK)}, '\\1\\2', 'g')"
    c = chain(c, [*P.DOMAIN_TERMS, *P.CONFUSIONS, *P.SPLIT_WORDS])
    for k, letter in enumerate(FOREIGN):
        c = f"replace({c}, '_9{k:03d}_', '{letter}')"
    return strip(f"regexp_replace(regexp_replace({c}, '[ \\t]{{2,}}', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


STEP = """lambda a, b: CASE WHEN a.cur <> '' AND length(a.cur) + length(b.cur) > 1000
  THEN {'cur': (CASE WHEN length(a.cur) > 200 THEN right(a.cur, 200) ELSE '' END) || ' ' || b.cur, 'ids': b.ids, 'done': list_append(a.done, a.ids || chr(1) || STRIPPED)}
  ELSE {'cur': GROWN, 'ids': CASE WHEN a.ids = '' THEN b.ids ELSE a.ids || ',' || b.ids END, 'done': a.done} END"""
STEP = STEP.replace("STRIPPED", strip("a.cur")).replace("GROWN", strip("a.cur || ' ' || b.cur"))
def chunked(source: str = "documents") -> str:
    return f"""{lines(source)}, folded AS (SELECT file_id, doc_id, max(page_num) AS page_num, list_reduce(list_prepend({{'cur': '', 'ids': '',
      'done': CAST([] AS VARCHAR[])}},
      list({{'cur': line, 'ids': CAST(seq AS VARCHAR), 'done': CAST([] AS VARCHAR[])}} ORDER BY seq)), {STEP}) AS s
  FROM lines WHERE line <> '' GROUP BY 1, 2), parts AS (SELECT file_id, doc_id, page_num, list_append(s.done,
      s.ids || chr(1) || {strip('s.cur')}) AS a FROM folded),
  chunks AS (SELECT file_id, doc_id, page_num, format('chk_{{:04d}}', k) AS chunk_id, string_split(c, chr(1))[2] AS text, string_split(c,
      chr(1))[1] AS block_ids
    FROM (SELECT file_id, doc_id, page_num, generate_subscripts(a, 1) AS k, unnest(a) AS c FROM parts))"""


CHUNKS = chunked()
UUID = """(SELECT doc_id, chunk_id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(CAST(doc_id AS VARCHAR) || ':' || chunk_id)) AS h
      FROM chunks)"""
RULES = " ".join(
    f"WHEN {(' AND ' if how == 'all' else ' OR ').join(f'contains(lower(text), {q(w[1:])})' if w[0] == '~' else f'contains(text, {q(w)})' for w in words)}"
    f" THEN {q(found)}"
    for (how, words), found in P.QUERY_RULES
)
DOT = lambda x, y: f"list_dot_product(CAST({x}.embedding AS DOUBLE[]), CAST({y}.embedding AS DOUBLE[]))"
COSINE = f"round({DOT('a', 'b')} / (sqrt({DOT('a', 'a')}) * sqrt({DOT('b', 'b')})), 6)"
KNN = f"""knn AS (SELECT a.vec_id AS query_id, a.label AS query_label, b.vec_id, b.label, {COSINE} AS score FROM embeddings a, embeddings b
      WHERE a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
  top AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM knn QUALIFY rank <= 10)"""
FILLED = f"list_filter(list_transform(r, lambda c: {strip('c')}), lambda c: c <> '')"
ROW = f"array_to_string({FILLED}, ' ')"
TOC_LIKE = f"""(len(rows) > 0 AND (2 * len(list_filter(rows, lambda r: regexp_matches(array_to_string(r, ' '), {q(P.DOT_LEADER)}))) > len(rows)
  OR 10 * len(list_filter(rows, lambda r: len(list_distinct({FILLED})) < len({FILLED}))) > 4 * len(rows)))"""
DEGENERATE = f"""CASE WHEN len(rows) = 0 OR len(headers) = 0 THEN 'empty' WHEN len(rows) <= 1 AND len(headers) <= 1 THEN 'single_cell'
  WHEN len(list_filter(headers, lambda h: lower({strip('h')}) NOT IN ({', '.join(map(q, P.GENERIC_HEADERS))}))) = 0 THEN 'generic_headers'
  WHEN 10 * len(list_filter(rows, lambda r: len({FILLED}) <= 1)) > 4 * len(rows) THEN 'sparse_rows' END"""
DOUBTFUL = f"""{TAB}, doubtful AS (SELECT file_id, page_num, doc_id, CASE WHEN doc_id % 3 = 1 THEN headers[1:1] ELSE headers END AS headers,
  CASE doc_id % 3 WHEN 0 THEN list_transform(rows, lambda r: list_transform(r, lambda c: c || ' ....... 7')) WHEN 1 THEN [['only cell ' || doc_id]]
      ELSE rows END AS rows FROM tab),
  fates AS (SELECT *, CASE WHEN {TOC_LIKE} THEN 'toc' ELSE {DEGENERATE} END AS fate FROM doubtful)"""
_MARKED = "CASE WHEN doc_id % 2 = 0 AND length(c) % 4 = 0 THEN '' ELSE c END"
_HEADER = "CASE WHEN doc_id % 2 = 0 AND length(h) % 4 = 0 THEN 'Col_' || (i + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END) ELSE h END"
_DIGITS = "len(headers) > 0 AND len(list_filter(headers, lambda h: NOT regexp_matches(h, '^[0-9]+$'))) = 0"
CLEAN_HEADERS = f"""CASE WHEN {_DIGITS} AND len(headers) = 2 THEN ['Section / Unit', 'Page Number'] WHEN {_DIGITS} THEN list_transform(headers,
      lambda h: 'Column_' || (TRY_CAST(h AS HUGEINT) + 1)) ELSE headers END"""
_FIRST = strip("coalesce(r[1], '')")
_PHANTOM = f"""(len(rows) > 0 AND len(headers) > 0
  AND len(list_filter(rows, lambda r: NOT ({_FIRST} = '' OR regexp_matches({_FIRST}, {q(P.any_of(P.TABLE_BOILERPLATE))})))) = 0)"""
#: Tables as the query damages them, then placeholders, headers, phantom columns and citations put right.
REPAIRED = f"""{TAB}, damaged AS (SELECT file_id, page_num, doc_id, CASE WHEN doc_id % 4 = 0 THEN 'A caption' ELSE '' END AS caption,
    CASE WHEN doc_id % 3 = 0 THEN ['BHIC-101'] ELSE [] END || list_transform(headers, lambda h, i: {_HEADER}) AS headers,
    list_transform(rows, lambda r: CASE WHEN doc_id % 3 = 0 THEN ['Page Nos.'] ELSE [] END || list_transform(r, lambda c: {_MARKED})) || CASE
      WHEN doc_id % 3 = 0 THEN [] ELSE [['(Adapted from Unit 3)', ''], ['(Source: p. 7)']] END AS rows FROM tab),
  cleaned AS (SELECT * REPLACE ({CLEAN_HEADERS} AS headers) FROM damaged),
  unphantomed AS (SELECT * REPLACE (CASE WHEN {_PHANTOM} THEN headers[2:] ELSE headers END AS headers, CASE
      WHEN {_PHANTOM} THEN list_transform(list_filter(rows, lambda r: len(r) > 1), lambda r: r[2:]) ELSE rows END AS rows) FROM cleaned),
  cited AS (SELECT *, list_transform(list_filter(rows, lambda r: regexp_matches({ROW}, {q(P.CITATION_ROW)})), lambda r: {ROW}) AS cites
      FROM unphantomed),
  repaired AS (SELECT * REPLACE (list_filter(rows, lambda r: NOT regexp_matches({ROW}, {q(P.CITATION_ROW)})) AS rows,
    CASE WHEN len(cites) = 0 THEN caption WHEN caption = '' THEN cites[1] || array_to_string(list_transform(cites[2:], lambda x: ' (' || x || ')'),
      '')
    ELSE caption || array_to_string(list_transform(cites, lambda x: ' (' || x || ')'), '') END AS caption) FROM cited)"""
MARK = PART("file_id", 1 << 32)
COUNTS = [
    "total_blocks", "content_blocks", "boilerplate_blocks", "corrected_blocks", "entity_count", "table_count", "ocr_errors", "placeholder_boxes",
    "duplicates", "unmerged",
]
RULES_9 = ["valid_json", "has_metadata", "has_blocks", "pages_valid", "types_valid", "texts_filled", "tagged", "tables_valid", "has_entities"]
#: The audit's files, blocks and tables, as the queries take them apart.
AUDITED = f"""{PASSES}, {TAB}, {EXPECTED}, files AS (SELECT *, {MARK} % 11 <> 0 AS there, {MARK} % 13 = 0 AS corrupt, {MARK} % 7 <> 0 AS named,
      {MARK} % 6 <> 0 AS chunked FROM expected),
  kept AS (SELECT * REPLACE (CASE WHEN {MARK} % 8 <> 0 THEN is_boilerplate END AS is_boilerplate), {MARK} % 9 <> 0 AS has_e,
      length(text) % 50 = 7 AS placeholder FROM done),
  shaped AS (SELECT file_id, bool_and(doc_id % 10 <> 0) AS ok FROM tab GROUP BY 1),
  held AS (SELECT file_id, true AS has_blocks, bool_and(page_num >= 1) AS pages_valid, bool_and(coalesce({isin('type', P.BLOCK_TYPES)},
      false)) AS types_valid, bool_and(type = 'blank_page' OR line <> '') AS texts_filled,
    bool_and(is_boilerplate IS NOT NULL) AS tagged, bool_and(has_e) AS has_entities FROM kept GROUP BY 1),
  ruled AS (SELECT f.file_id, NOT corrupt AS valid_json, NOT corrupt AND named AS has_metadata, NOT corrupt AND coalesce(has_blocks,
      false) AS has_blocks, NOT corrupt AND coalesce(pages_valid, false) AS pages_valid,
    NOT corrupt AND coalesce(types_valid, false) AS types_valid, NOT corrupt AND coalesce(texts_filled, false) AS texts_filled, NOT corrupt
      AND coalesce(tagged, false) AS tagged,
    NOT corrupt AND coalesce(has_blocks, false) AND coalesce(ok, true) AS tables_valid, NOT corrupt AND coalesce(has_entities, false) AS has_entities
    FROM files f LEFT JOIN held USING (file_id) LEFT JOIN shaped USING (file_id)),
  rules AS (SELECT *, {' + '.join(f'CAST({n} AS INTEGER)' for n in RULES_9)} AS passed
      FROM ruled)"""
EVALUATED = f"""{AUDITED}, {COVERED.replace('FRAME', 'kept')}, counts AS (SELECT file_id, count(*) AS total_blocks,
      count(*) FILTER (NOT coalesce(is_boilerplate, false)) AS content_blocks, count(*) FILTER (is_boilerplate) AS boilerplate_blocks,
    count(*) FILTER (was_corrected) AS corrected_blocks, count(*) FILTER (has_e AND regexp_matches(text, '[0-9]{{4}}')) AS entity_count,
    count(*) FILTER (contains(text, {q(P.OCR_WORD)}) OR regexp_matches(text, {q(P.OCR_RESIDUE)})) AS ocr_errors,
      count(*) FILTER (placeholder) AS placeholder_boxes FROM kept GROUP BY 1),
  kept2 AS (SELECT * REPLACE (coalesce(is_boilerplate, false) AS is_boilerplate) FROM kept),
  merged AS (SELECT f.file_id, f.expected, missing_pages, coverage_pct, passed,
      {', '.join(f'coalesce({n}, 0) AS {n}' for n in COUNTS)}
    FROM files f LEFT JOIN counts USING (file_id) LEFT JOIN (SELECT file_id, count(*) AS table_count FROM tab GROUP BY 1) USING (file_id) LEFT
      JOIN rules USING (file_id) LEFT JOIN (SELECT file_id, missing_pages, coverage_pct FROM covered) USING (file_id)
    LEFT JOIN ({CONTAMINATED.replace('FRAME', 'kept')}) USING (file_id) LEFT JOIN {UNMERGED.replace('FRAME', 'kept2')} USING (file_id) WHERE f.there),
  issues AS (SELECT *, CAST(missing_pages <> '' AS INTEGER) + CAST(content_blocks = 0 AND expected > 0 AS INTEGER) AS high,
      CAST(ocr_errors > 0 AS INTEGER) + CAST(duplicates > 0 AS INTEGER) AS medium,
    CAST(unmerged > 0 AS INTEGER) + CAST(placeholder_boxes > 0 AS INTEGER) AS low,
    concat_ws(', ', CASE WHEN missing_pages <> '' THEN 'Completeness (High)' END, CASE WHEN unmerged > 0 THEN 'Continuity (Low)' END,
      CASE WHEN ocr_errors > 0 THEN 'OCR Errors (Medium)' END, CASE WHEN duplicates > 0 THEN 'Duplicate Content (Medium)' END,
      CASE WHEN placeholder_boxes > 0 THEN 'Data Integrity (Low)' END, CASE WHEN content_blocks = 0 AND expected > 0 THEN 'Readability (High)' END) AS issues
    FROM merged),
  scored AS (SELECT * EXCLUDE (expected, missing_pages), greatest(0.0::DOUBLE, least(100.0::DOUBLE,
      {rounded("100 - 0.3::DOUBLE * (100 - coverage_pct) - 2.2::DOUBLE * (9 - passed) - 15 * high - 5 * medium - 2 * low", 1)})) AS score FROM issues
    UNION ALL BY NAME SELECT file_id, 0.0::DOUBLE AS coverage_pct, 0 AS passed,
      {', '.join(f'0 AS {n}' for n in COUNTS)},
    1 AS high, 0 AS medium, 0 AS low, 'Completeness (High)' AS issues, 0.0::DOUBLE AS score FROM files WHERE NOT there),
  rated AS (SELECT *, rating IN ('Excellent', 'Good') AS ready FROM (SELECT *, CASE WHEN score >= 90 THEN 'Excellent' WHEN score >= 75 THEN 'Good'
      WHEN score >= 55 THEN 'Fair' ELSE 'Poor' END AS rating FROM scored))"""
SCANNED = f"""p AS (SELECT file_id, page_num, string_agg(CASE {PART('file_id', 3)} WHEN 0 THEN lang WHEN 1 THEN repeat(chr(10), 200) ELSE text END, ' ') AS text FROM
    (SELECT concat(source, '-', doc_id // 2000) AS file_id, CAST(doc_id % 2000 // 20 + 1 AS INTEGER) AS page_num, lang, coalesce(text, '') AS text
      FROM documents) GROUP BY 1, 2),
  n AS (SELECT *, greatest(max(page_num) OVER (PARTITION BY file_id) // 8, 1) AS step FROM p),
  scans AS (SELECT file_id, avg(length({strip('text')})) < 150 AS scanned FROM n WHERE (page_num - 1 - step // 2) % step = 0 AND (page_num - 1) // step < 8
      GROUP BY 1)"""
INGESTED = f"""{CHUNKS}, c AS (SELECT doc_id, count(*) AS n FROM chunks GROUP BY 1), f AS
      (SELECT CAST(d.doc_id AS VARCHAR) AS file_id, coalesce(c.n, 0) AS chunks FROM documents d LEFT JOIN c USING (doc_id)
        UNION ALL SELECT 'page-' || page_id, 0 FROM pages),
  ingested AS (SELECT run, file_id, chunks, CASE WHEN run = 'run' THEN chunks ELSE 0 END AS vectors, CASE WHEN chunks = 0 THEN 'error'
      WHEN run = 'run' THEN 'ok' ELSE 'dry_run' END AS status,
    CASE WHEN chunks = 0 THEN 'No chunks in preprocessed JSON' END AS error FROM f, (VALUES ('run'), ('dry')) r(run))"""
ORACLE_SQL |= {
    "correct_text_basic": f"SELECT doc_id, {corrected('text')} AS text FROM {PLANTED}",
    "chunk_fold": f"""WITH {CHUNKS} SELECT doc_id, chunk_id, text, CAST(length(text) AS INTEGER) AS character_count, block_ids,
      CAST(page_num AS VARCHAR) AS pages FROM chunks""",
    "chunk_documents": f"""WITH {CHUNKS} SELECT file_id || '/' || doc_id AS file_id, chunk_id, text, CAST(length(text) AS INTEGER) AS character_count,
      CAST(page_num AS VARCHAR) AS pages,
      array_to_string(list_transform(string_split(block_ids, ','), lambda x: format('blk_{{:04d}}', CAST(x AS INTEGER) + 1)), ',') AS block_ids
      FROM chunks""",
    "fenced_answers": f"SELECT doc_id, {strip("coalesce(text, '')")} AS text FROM documents",
    "chunk_stats": f"""WITH {CHUNKS} SELECT file_id, count(*) AS chunks, CAST(min(length(text)) AS INTEGER) AS shortest,
      CAST(max(length(text)) AS INTEGER) AS longest, CAST(round(CAST(avg(length(text)) AS DECIMAL(20, 6)), 2) AS DOUBLE) AS mean FROM chunks
      GROUP BY 1""",
    "chunk_totals": f"""WITH {CHUNKS} SELECT CASE WHEN grouping(file_id) = 1 THEN 'TOTAL' ELSE file_id END AS file_id, count(*) AS chunks FROM chunks
      GROUP BY ROLLUP (file_id)""",
    "point_ids": f"""WITH {CHUNKS} SELECT doc_id, chunk_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab',
      CAST(instr('0123456789abcdef', h[17:17]) - 1 AS INTEGER) % 4 + 1, 1) || h[18:20] || '-' || h[21:32] AS point_id FROM {UUID}""",
    "query_synthesis": f"""WITH {chunked(PLANTED)} SELECT query, min(c) AS expected FROM (SELECT CASE {RULES} END AS query, format('{{:012d}}/{{}}',
      doc_id, chunk_id) AS c FROM chunks) WHERE query IS NOT NULL GROUP BY 1""",
    "retrieval_report": f"""WITH {chunked(PLANTED)},
      own AS (SELECT doc_id * 2147483648 + CAST(substr(chunk_id, 5) AS BIGINT) AS vec_id, format('{{:012d}}/{{}}', doc_id, chunk_id) AS c, text FROM chunks),
      asked AS (SELECT query, min(c) AS c FROM (SELECT CASE {RULES} END AS query, c FROM own) WHERE query IS NOT NULL GROUP BY 1),
      bags AS (SELECT k, place, count(*) AS n FROM (SELECT k, {PART('w', 64)} AS place FROM (SELECT k, unnest(string_split_regex(lower(t), '[\\x20\\x09-\\x0D]+')) AS w
        FROM (SELECT c AS k, text AS t FROM own UNION ALL SELECT query, query FROM asked)) WHERE w <> '') GROUP BY 1, 2),
      norms AS (SELECT k, sqrt(sum(n * n)) AS norm FROM bags GROUP BY 1),
      sims AS (SELECT a.query, o.vec_id, o.c, round(sum(x.n * y.n) / (max(p.norm) * max(r.norm)), 6) AS score FROM asked a JOIN bags x ON x.k = a.query JOIN norms p ON p.k = a.query
        JOIN bags y ON y.place = x.place JOIN own o ON o.c = y.k JOIN norms r ON r.k = o.c GROUP BY 1, 2, 3),
      ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM sims)
      SELECT a.query, coalesce(r.rank, 0) AS rank FROM asked a LEFT JOIN ranked r ON r.query = a.query AND r.c = a.c AND r.rank <= 10""",
    "knn_top10": f"WITH {KNN} SELECT query_id, vec_id, score, rank FROM top",
    "recall_mrr_ndcg": f"""WITH {KNN}, hit AS (SELECT query_id, min(rank) AS rank FROM top WHERE label = query_label GROUP BY 1), r AS
      (SELECT coalesce(h.rank, 0) AS rank FROM embeddings e LEFT JOIN hit h ON h.query_id = e.vec_id WHERE e.vec_id % 50 = 0)
      SELECT count(*) AS queries, round(avg(CASE WHEN rank > 0 THEN 1 / rank ELSE 0 END), 6) AS mrr, round(avg(CASE WHEN rank BETWEEN 1
      AND 5 THEN 1 / log2(rank + 1) ELSE 0 END), 6) AS ndcg5,
      round(avg(CAST(rank BETWEEN 1 AND 5 AS INTEGER)), 6) AS recall5, round(avg(CAST(rank BETWEEN 1 AND 10 AS INTEGER)), 6) AS recall10 FROM r""",
    "hashed_embedding": """WITH w AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64 AS INTEGER) AS place FROM (SELECT doc_id,
      unnest(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+')) AS w FROM documents) WHERE w <> ''),
      c AS (SELECT doc_id, place, count(*) AS n FROM w GROUP BY 1, 2) SELECT doc_id, place, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)),
      6) AS value FROM c""",
    "embedding_misfits": "SELECT vec_id FROM embeddings WHERE vec_id % 3 <> 0",
    "ner_counts": f"WITH {lines(PLANTED)} "
    + " UNION ALL ".join(
        f"SELECT * FROM (SELECT {q(label)} AS label, CAST(sum(len(regexp_extract_all(text, {q(p)}))) AS BIGINT) AS mentions FROM lines) WHERE mentions > 0"
        for label, p in P.ENTITIES
    ),
    "table_filter": f"""WITH {TAB} SELECT doc_id, CAST(len(rows) AS INTEGER) AS row_count, CAST(len(headers) AS INTEGER) AS column_count,
      {TOC_LIKE} AS toc_like FROM tab""",
    "degenerate_tables": f"WITH {TAB} SELECT doc_id, {DEGENERATE} AS reason FROM tab",
    "table_headers": f"""WITH {TAB}, d AS (SELECT doc_id, list_transform(headers, lambda h: CASE WHEN doc_id % 2 = 0 THEN CAST(length(h) AS VARCHAR)
      ELSE h END) AS headers FROM tab) SELECT doc_id, array_to_string({CLEAN_HEADERS}, '|') AS headers FROM d""",
    "table_repair": f"""WITH {REPAIRED} SELECT doc_id, format('tbl_{{:03d}}', row_number() OVER (PARTITION BY file_id ORDER BY page_num,
      doc_id)) AS table_id, caption, CAST(len(rows) AS INTEGER) AS row_count, CAST(len(headers) AS INTEGER) AS column_count,
      array_to_string(headers, '|') AS headers, array_to_string(list_transform(rows, lambda r: array_to_string(r, '|')), '/') AS cells
      FROM repaired""",
    "table_review": f"""WITH {DOUBTFUL} SELECT doc_id, fate IS NOT NULL AS needs_review, CAST(len(rows) AS INTEGER) AS row_count FROM fates
      WHERE fate IS NULL OR fate IN ('generic_headers', 'sparse_rows')""",
    "table_row_rescue": f"""WITH {DOUBTFUL}, u AS (SELECT file_id, page_num, doc_id, fate = 'toc' AS toc, CAST(generate_subscripts(rows,
      1) AS INTEGER) AS k, unnest(rows) AS r FROM fates WHERE fate IN ('toc', 'empty', 'single_cell')),
      t AS (SELECT *, {norm('text')} AS n FROM (SELECT * EXCLUDE (r), {ROW} AS text FROM u) WHERE text <> ''),
      f AS (SELECT * FROM t WHERE (file_id, n) NOT IN (SELECT (file_id, {norm('text')}) FROM plain) QUALIFY row_number() OVER (PARTITION BY file_id,
      n ORDER BY NOT toc, page_num, doc_id, k, text) = 1)
      SELECT file_id, page_num, CASE WHEN toc THEN 'toc' ELSE 'list_item' END AS type, text, toc AS is_boilerplate, CASE
      WHEN toc THEN 'toc' END AS boilerplate_type, NOT toc AS was_corrected FROM f""",
    "qa_rules": f"WITH {AUDITED} SELECT * FROM rules",
    "evaluation": f"WITH {EVALUATED} SELECT * FROM rated",
    "audit_report": f"""WITH {EVALUATED} SELECT file_id,
      '| ' || file_id || ' | ' || score || ' | ' || rating || ' | ' || coverage_pct || ' | ' || CASE WHEN ready THEN 'yes'
      ELSE 'no' END || ' |' AS line FROM rated""",
    "batch_checks": f"""WITH {AUDITED}, c AS (SELECT file_id, count(*) AS n FROM (SELECT file_id, doc_id FROM plain WHERE {strip('text')} <> ''
      GROUP BY 1, 2) WHERE {PART('file_id', 4)} <> 0 GROUP BY 1),
      s AS (SELECT file_id, count(*) AS blocks, count(*) FILTER (NOT coalesce(is_boilerplate, false)) AS content,
      count(*) FILTER (type <> 'blank_page' AND NOT coalesce(is_boilerplate, false) AND line = '') AS blank,
        count(*) FILTER (NOT coalesce({isin('type', P.BLOCK_TYPES)}, false)) AS odd, count(*) FILTER (is_boilerplate IS NULL) AS untagged,
      count(*) FILTER (NOT has_e) AS plain_n, list(page_num) AS seen FROM kept GROUP BY 1),
      j AS (SELECT f.*, coalesce(blocks, 0) AS blocks, coalesce(content, 0) AS content, coalesce(blank, 0) AS blank, coalesce(odd, 0) AS odd,
      coalesce(untagged, 0) AS untagged, coalesce(plain_n, 0) AS plain_n, coalesce(c.n, 0) AS chunk_n, there AND NOT corrupt AS ok,
        list_filter(range(1, expected + 1), lambda x: NOT list_contains(coalesce(seen, []), x)) AS gaps FROM files f LEFT JOIN s USING (file_id) LEFT
      JOIN c USING (file_id))
      SELECT file_id, checked, issue FROM (
        SELECT file_id, 1 AS checked, 'extraction missing' AS issue, NOT there AS hit FROM j UNION ALL SELECT file_id, 2, 'chunks missing', there
      AND NOT chunked FROM j
        UNION ALL SELECT file_id, 3, 'extraction corrupt', there AND NOT ok FROM j UNION ALL SELECT file_id, 4, 'no blocks', ok AND blocks = 0 FROM j
        UNION ALL SELECT file_id, 5, 'no content blocks', ok AND blocks > 0 AND content = 0 FROM j UNION ALL SELECT file_id, 6,
      'missing pages ' || array_to_string(gaps[1:10], ','), ok AND len(gaps) > 0 FROM j
        UNION ALL SELECT file_id, 7, blank || ' empty texts', ok AND blank > 0 FROM j UNION ALL SELECT file_id, 8, odd || ' invalid types', ok
      AND odd > 0 FROM j
        UNION ALL SELECT file_id, 9, untagged || ' untagged blocks', ok AND untagged > 0 FROM j UNION ALL SELECT file_id, 10,
      plain_n || ' blocks without entities', ok AND plain_n > 0 FROM j
        UNION ALL SELECT file_id, 11, 'no chunks', ok AND chunked AND chunk_n = 0 FROM j) WHERE hit""",
    "rating_rollup": f"""WITH {EVALUATED} SELECT CASE WHEN grouping(folder) = 1 THEN 'TOTAL' ELSE folder END AS folder, count(*) AS documents,
      count(*) FILTER (rating = 'Excellent') AS excellent, count(*) FILTER (rating = 'Good') AS good, count(*) FILTER (rating = 'Fair') AS fair,
      count(*) FILTER (rating = 'Poor') AS poor, count(*) FILTER (ready) AS ready, {rounded("CAST(avg(score) AS DECIMAL(20, 5))", 1)} AS mean_score,
      {rounded("CAST(avg(coverage_pct) AS DECIMAL(20, 6))", 1)} AS mean_coverage,
      {', '.join(f'CAST(sum({n}) AS BIGINT) AS {n}' for n in ('total_blocks', 'content_blocks', 'corrected_blocks', 'entity_count'))} FROM (SELECT *,
      left(file_id, 4) AS folder FROM rated) GROUP BY ROLLUP (folder)""",
    "scan_type": f"WITH {SCANNED} SELECT * FROM scans",
    "engine_route": f"""WITH {SCANNED} SELECT file_id, CASE {PART('file_id', 5)} WHEN 0 THEN 'vlm' WHEN 1 THEN 'layout' ELSE CASE
      WHEN scanned THEN 'vlm' ELSE 'layout' END END AS engine FROM scans""",
    "ingest_stats": f"WITH {INGESTED} SELECT * FROM ingested",
    "failed_files": f"WITH {INGESTED} SELECT run, file_id, error FROM ingested WHERE status = 'error'",
    "file_match": """SELECT d.source || '/' || d.doc_id AS stem, l.doc_id IS NOT NULL AS found FROM documents d LEFT JOIN (SELECT DISTINCT doc_id
      FROM labels) l USING (doc_id)""",
    "json_blocks": f"""WITH {LINES} SELECT doc_id, seq AS block_no, format('blk_p{{:04d}}_{{:03d}}', doc_id, seq + 1) AS block_id, CASE
      WHEN seq % 3 = 0 THEN 'paragraph' WHEN seq % 5 = 0 THEN 'footer' ELSE 'list_item' END AS type, line AS text, seq % 5 = 0 AS is_boilerplate,
      CASE WHEN seq % 5 = 0 AND seq % 3 <> 0 THEN 'footer' END AS boilerplate_type, CAST(doc_id AS INTEGER) AS page_num, false AS was_corrected,
      'vlm' AS source, CASE WHEN seq % 4 = 0 THEN seq || '.0,1.5,2.0,3.0' ELSE '0.0,0.0,612.0,792.0' END AS bbox FROM lines WHERE line <> ''""",
    "document_json": f"""WITH {PASSES}, {TAB} SELECT file_id || '.pdf' AS file_name,
      count(*) FILTER (NOT is_boilerplate) OVER (PARTITION BY file_id) AS content_blocks, coalesce(n, 0) AS table_count,
      count(*) FILTER (type = 'heading') OVER (PARTITION BY file_id) AS image_count,
      count(*) FILTER (regexp_matches(text, '[0-9]')) OVER (PARTITION BY file_id) AS total_ner_entities, CAST(coalesce(n, 0) AS INTEGER) AS tables,
      doc_id, seq, type, text, is_boilerplate FROM done LEFT JOIN (SELECT file_id, count(*) AS n FROM tab GROUP BY 1) USING (file_id)""",
}
RANKED = ORACLE_SQL["retrieval_report"].replace("SELECT a.query, coalesce(r.rank, 0) AS rank FROM asked", "SELECT coalesce(r.rank, 0) AS rank FROM asked")
REPORT = f"""totals AS (SELECT count(*) AS n, count(*) FILTER (ready) AS ready, {rounded("CAST(avg(score) AS DECIMAL(20, 5))", 1)} AS score,
    {rounded("CAST(avg(coverage_pct) AS DECIMAL(20, 6))", 1)} AS coverage,
    {', '.join(f'sum({n}) AS {n}' for n in ('total_blocks', 'content_blocks', 'corrected_blocks', 'entity_count'))},
    {', '.join(f"count(*) FILTER (rating = '{r}') AS {r}" for r in ('Excellent', 'Good', 'Fair', 'Poor'))} FROM rated),
  heads AS (SELECT 1 AS part, unnest(['Files: ' || n, 'Mean confidence: ' || score || '%', 'Mean coverage: ' || coverage || '%',
      'Ready: ' || ready || ' of ' || n || ' (' || {rounded('100 * ready / greatest(n, 1)', 1)} || '%)',
      'Blocks: ' || total_blocks || ', content: ' || content_blocks || ', corrected: ' || corrected_blocks, 'Entities: ' || entity_count]) AS line,
      unnest(range(6)) AS place FROM totals
    UNION ALL SELECT 2, unnest([{', '.join(f"'| {r} | ' || {r} || ' | ' || {rounded(f'100 * {r} / greatest(n, 1)', 1)} || '% |'" for r in ('Excellent', 'Good', 'Fair', 'Poor'))}]),
      unnest(range(4)) FROM totals),
  kinds AS (SELECT issue, count(*) AS files FROM (SELECT unnest(string_split(issues, ', ')) AS issue FROM rated) WHERE issue <> '' GROUP BY 1)"""
ORACLE_SQL |= {
    "retrieval_measures": f"""SELECT 'hashed words' AS model, 64 AS dims, count(*) AS queries, round(avg(CASE WHEN rank > 0 THEN 1 / rank ELSE 0 END), 6) AS mrr,
      round(avg(CASE WHEN rank BETWEEN 1 AND 5 THEN 1 / log2(rank + 1) ELSE 0 END), 6) AS ndcg5, round(avg(CAST(rank BETWEEN 1 AND 5 AS INTEGER)), 6) AS recall5,
      round(avg(CAST(rank BETWEEN 1 AND 10 AS INTEGER)), 6) AS recall10 FROM ({RANKED})""",
    "corpus_report": f"""WITH {EVALUATED}, {REPORT} SELECT part, place, line FROM heads
      UNION ALL SELECT 3, row_number() OVER (ORDER BY issue) - 1, '| ' || issue || ' | ' || files || ' |' FROM kinds
      UNION ALL SELECT 4, row_number() OVER (ORDER BY file_id) - 1, '| ' || row_number() OVER (ORDER BY file_id) || ' | ' || file_id || ' | ' || coverage_pct ||
      '% | ' || passed || '/9 | ' || score || '% | ' || rating || ' | ' || CASE WHEN ready THEN 'yes' ELSE 'no' END || ' |' FROM rated""",
    "blank_marked": f"""WITH {PASSES}, m AS (SELECT file_id, page_num FROM done GROUP BY 1, 2
      HAVING bool_and(is_boilerplate OR length(text) < 60 OR type IN ('header', 'footer', 'toc_page_number'))),
      b AS (SELECT file_id, page_num, doc_id, seq, type, 0 AS marker FROM done UNION ALL SELECT file_id, page_num, NULL, NULL, 'blank_page', 1 FROM m)
      SELECT file_id, page_num, doc_id, seq, type, CAST(row_number() OVER (PARTITION BY file_id ORDER BY page_num, marker, doc_id, seq) AS INTEGER) AS position FROM b""",
    "html_elements": ORACLE_SQL["html_blocks"],
    "latest_status_stream": ORACLE_SQL["latest_status"],
    "upserted_documents": """SELECT d.doc_id, md5(CASE WHEN l.doc_id IS NULL THEN coalesce(text, '') ELSE coalesce(text || '!', '') END) AS text_md5, lang,
      CASE WHEN l.doc_id IS NULL THEN 0 ELSE CAST(quality + 1 AS INTEGER) END AS version FROM documents d LEFT JOIN labels l USING (doc_id)""",
}
