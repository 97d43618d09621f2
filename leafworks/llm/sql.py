"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
DELETED = "regexp_replace({}, '[\\x20\\x09-\\x0D]', '', 'g')"
LINE_LISTS = "SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents"

LINE_DEDUP = f"""WITH l AS (SELECT doc_id, generate_subscripts(a, 1) AS k, unnest(a) AS line FROM ({LINE_LISTS})),
  keyed AS (SELECT *, translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
  g AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
  FROM keyed LEFT JOIN g USING (key) GROUP BY doc_id"""

EXACT_DEDUP = f"""WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS c, {DELETED.format("coalesce(text, '')")} AS norm FROM documents),
  g AS (SELECT norm, count(*) AS group_size, first(doc_id ORDER BY c DESC, doc_id) AS keep_id FROM n GROUP BY norm)
  SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)"""

QUALITY = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM (SELECT doc_id, unnest(a) AS line FROM ({LINE_LISTS}))
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
  words AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM d),
  stutters AS (SELECT doc_id, count(*) AS stutter FROM (SELECT doc_id, word, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM words)
      WHERE word = before GROUP BY 1),
  windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i
      FROM d)),
  twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
  repeats AS (SELECT doc_id, sum(least(8, coalesce(after - i, 8))) AS r FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after
      FROM twice) GROUP BY 1),
  m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, length({DELETED.format('t')}) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]',
      '', 'g')) AS BIGINT) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
    CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(stutter, 0) AS stutter, length(regexp_replace(t,
      '[^A-Z]', '', 'g')) AS capitals, length(regexp_replace(t, '[^a-z]', '', 'g')) AS small, length(regexp_replace(t, '[^!]', '', 'g')) AS shouts
    FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN stutters USING (doc_id) LEFT JOIN repeats USING (doc_id)),
  b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR 10 * n_symbols > n_words
      OR (capitals > 20 AND capitals > small) OR 5 * shouts > n_words
    OR 100 * stutter > 30 * n_words OR 100 * n_dup_lines > 75 * n_lines OR (n_words > 0 AND (word_chars < 2 * n_words
      OR word_chars > 20 * n_words))) AS kept FROM b"""

NEAR_DEDUP = """WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4,
      CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM d)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
  links AS (SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
  ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
  reached AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reached.doc_id, ways.y FROM reached JOIN ways ON ways.x = reached.r),
  c AS (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY 1)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""

ESCAPED = "length(regexp_replace({}, '<(\\\\*)\\|', '<\\1\\\\|', 'g'))"
CHAT = f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
  c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
      coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(23 + {ESCAPED.format('role')} + {ESCAPED.format('text')}) AS BIGINT) AS formatted_chars FROM turns GROUP BY 1)
  SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c"""

DIGITS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
GROUP = " || ".join(f"substr({DIGITS}, CAST((v >> {s}) & 31 AS INTEGER) + 1, 1)" for s in (15, 10, 5, 0))
WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS lead FROM pages),
  parts AS (SELECT page_id, j, CAST('0x' || substr(sha1(html), 5 * j + 1, 5) AS BIGINT) AS v FROM p, range(0, 8) r(j)),
  digests AS (SELECT page_id, string_agg({GROUP}, '' ORDER BY j) AS payload_digest FROM parts GROUP BY 1)
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = lead THEN 'response'
      ELSE 'revisit' END AS record_type, CASE WHEN page_id <> lead THEN lead END AS refers_to FROM p JOIN digests USING (page_id)"""

SHARE = "1 + (1000000000 * CAST({n} + 2 AS HUGEINT)) // CAST({total} + 2 * v AS HUGEINT)"
APART = "CAST(({p} - {q}) * ({p} - {q}) // ({p} + {q}) AS BIGINT)"
SOURCE_AUDIT = f"""WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  w AS (SELECT row, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
  k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT row) >= 10),
  langs AS (SELECT lang, count(k.term) AS v, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang FROM d) LEFT JOIN k USING (lang) GROUP BY 1),
  c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY 1, 2, 3),
  g AS (SELECT lang, source, coalesce(sum(n), 0) AS total, any_value(v) AS v FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source)
      JOIN (SELECT lang, v FROM langs) USING (lang) GROUP BY 1, 2),
  p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {SHARE.format(n="coalesce(c.n, 0)", total="g.total")} AS p FROM g JOIN k USING (lang)
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
  far AS (SELECT a.lang, a.source, b.source AS item, sum({APART.format(p="a.p", q="b.p")}) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term
      AND a.source <> b.source GROUP BY 1, 2, 3),
  pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b
      ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
  q AS (SELECT k.lang, k.term, {SHARE.format(n="k.n", total="langs.total")} AS q FROM k JOIN langs USING (lang)),
  terms AS (SELECT lang, source, 'term' AS part, term AS item, {APART.format(p="p", q="q")} AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
  SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""

ORACLE_SQL = {
    "op2_line_dedup": LINE_DEDUP,
    "op3_near_dedup": NEAR_DEDUP,
    "op5_exact_dedup": EXACT_DEDUP,
    "op6_quality_rules": QUALITY,
    "op7_chat_format": CHAT,
    "op10_warc": WARC,
    "op11_source_audit": SOURCE_AUDIT,
}
