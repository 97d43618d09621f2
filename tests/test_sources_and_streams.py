"""Data sources and sinks, the stateful stream, and the operators that replaced one-key or one-task plans."""

import json
import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from leafworks.operators import audit, blocks, chunks, entities, registry, sequences, vectors
from leafworks.functions import text as T
from leafworks.plans import catalog, sql
from leafworks.sources import elements, files, html, packed, store, upserts
from leafworks.streaming import lifecycle

PAGE = '<nav><ul><li><a href="/x">one</a></li></ul></nav><p class="c">a <b>b</b> c<br>d <P>next</p> loose<h1>T<hr/>U</h1><footer>end</footer><pre>no</pre><li>x</td><TD a="1">y</li><p> <br></p>'


def pages(spark, n):
    rows = [(k, PAGE if k % 3 else f"<h1>page {k}</h1><p>ſKelvin</p><DIV><li>é {k}\n\tz</li>") for k in range(n)] + [(None, PAGE), (n, None), (n + 1, "")]
    return spark.createDataFrame(rows, "page_id long, html string").orderBy("page_id")


def test_breaks_and_cells_stand_between_words(spark):
    found = html.html_blocks(spark.createDataFrame([(1, PAGE)], "page_id long, html string")).orderBy("seq").collect()
    want = [("list_item", "one"), ("paragraph", "a b c d"), ("paragraph", "next"), ("heading", "T U"), ("footer", "end"), ("list_item", "x y")]
    assert [(r.type, r.text) for r in found] == want and [e[1:] for e in elements.elements(PAGE)] == want


def test_element_source(spark, tmp_path):
    df = pages(spark, 400)
    df.repartitionByRange(4, "page_id").sortWithinPartitions("page_id").write.option("parquet.block.size", 2000).parquet(f"{tmp_path}/pages")
    want = html.html_blocks(df)
    for split in ("700", "100000000"):  # many ranges a row group, and one a file
        found = elements.read_elements(spark, f"{tmp_path}/pages", split_bytes=split)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    for k, where in enumerate(("page_id >= 100 AND page_id < 130", "page_id = 7", "page_id > 390 AND type = 'heading'", "page_id <= 3 AND type IN ('paragraph', 'footer') AND length(text) > 3")):
        found = elements.read_elements(spark, f"file://{tmp_path}/pages", report=f"file://{tmp_path}/report{k}").where(where)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.where(where).collect()))
        # The filters reached the reader: it looked at no other pages, and at the row groups that may hold them.
        reports = [json.loads((tmp_path / f"report{k}" / f).read_text()) for f in os.listdir(tmp_path / f"report{k}")]
        asked = where.split(" AND type")[0]
        assert sum(r["pages"] for r in reports) == df.where(asked).count() and sum(r["row_groups"] > 0 for r in reports) <= 2
    (tmp_path / "none").mkdir()
    assert elements.read_elements(spark, f"{tmp_path}/none").count() == 0


SHAPE = "id long, v string, at long"


def table(spark, path, order=None):
    return {r.id: r.v for r in upserts.current(spark, path, SHAPE, "id", order).collect()}


def test_upsert_sink(spark, tmp_path, monkeypatch):
    path, rows = f"file://{tmp_path}/t", [(k, f"a{k}", k) for k in range(200)]
    first = spark.createDataFrame(rows, SHAPE).repartition(5)
    upserts.upsert(first, path, 0)
    assert table(spark, path) == {k: v for k, v, _ in rows}
    # A batch that is killed: some of its files are there, and no log entry.
    changed = spark.createDataFrame([(k, "b", k) for k in range(50, 300)] + [(7, "early", 1), (7, "late", 9)], SHAPE).repartition(3)
    upserts.Table(path, changed.schema).put(changed.toArrow().to_batches())
    assert table(spark, path) == {k: v for k, v, _ in rows}

    def fails(batches):
        for b in batches:
            yield b
            raise ValueError("lost")

    data = lambda: sorted(os.listdir(tmp_path / "t/data"))
    before = data()
    broken = changed.where("id < 100").union(changed.where("id >= 100").mapInArrow(fails, SHAPE))
    with pytest.raises(PySparkException):
        upserts.upsert(broken, path, 1)
    assert [f for f in data() if f not in before and os.path.getsize(tmp_path / "t/data" / f) and f.endswith("part")] == []
    assert [e["batch"] for e in upserts.entries(path)] == [0]
    # The batch written again, and once more under its number with other rows: each key is there once.
    upserts.upsert(changed, path, 1)
    files_after = data()
    upserts.upsert(first, path, 1)
    want = {k: v for k, v, _ in rows} | dict.fromkeys(range(50, 300), "b") | {7: "late"}
    assert table(spark, path, "at") == want and data() == files_after
    monkeypatch.setattr(upserts, "FILE_ROWS", 40)
    upserts.compact(spark, path, SHAPE, "id", "at")
    assert table(spark, path) == want and len(upserts.entries(path)) == 1
    upserts.upsert(spark.createDataFrame([(7, "new", 0)], SHAPE), path, 9)
    assert table(spark, path) == want | {7: "new"}
    assert upserts.current(spark, f"{tmp_path}/empty", SHAPE, "id").count() == 0
    with pytest.raises(PySparkException):
        first.write.format("upserts").mode("overwrite").option("batch", 10).save(path)


EVENTS = "user long, at long, status string, note double"


def random_events(r, n):
    return [(r.randrange(9) or None, r.randrange(400) if r.random() > 0.05 else None, r.choice(["new", "done", None]), r.choice([None, 1.5, 2.5])) for _ in range(n)]


def plain_latest(rows):
    out = defaultdict(lambda: [-1, (-1, ""), (-1, 0.0)])
    for u, at, s, note in rows:
        if u is not None and at is not None:
            x = out[u]
            out[u] = [max(x[0], at), max(x[1], (at, s)) if s else x[1], max(x[2], (at, note)) if note else x[2]]
    return {(u, a, s[1] or None, v[1] or None) for u, (a, s, v) in out.items()}


def test_lifecycle_in_any_order_and_over_restarts(spark, tmp_path):
    rows, path = random_events(random.Random(1), 300), f"file://{tmp_path}"
    for order in range(2):
        random.Random(order).shuffle(rows)
        for part in range(3):  # the second and third run go on from the first one's state
            own = rows[part * 100 : part * 100 + 100]
            spark.createDataFrame(own, EVENTS).coalesce(2 if part else 1).write.mode("append").parquet(f"{tmp_path}/in{order}")
            stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in{order}")
            changes = lifecycle.lifecycle(stream, "user", "at", {"status": "string", "note": "double"})
            lifecycle.followed(changes, f"{path}/table{order}", f"{path}/state{order}").awaitTermination()
            found = upserts.current(spark, f"{path}/table{order}", f"{EVENTS}, final boolean", "user", "at").drop("final")
            assert {tuple(x) for x in found.collect()} == plain_latest(rows[: part * 100 + 100])


def test_lifecycle_closes_keys_by_timers(spark, tmp_path):
    shape = "user long, at long, status string, ts timestamp"
    batches = [[(1, 1, "new", 0), (2, 2, "new", 10)], [(1, 3, "done", 20), (2, 1, "early", 5)], [(3, 9, "new", 9000)], [(3, 10, "done", 9001), (1, 2, "too late", 21)]]
    path = f"file://{tmp_path}"
    for k, rows in enumerate(batches):
        spark.createDataFrame([(u, a, s, 1_700_000_000 + t) for u, a, s, t in rows], "user long, at long, status string, ts long").withColumn("ts", F.timestamp_seconds("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(shape).parquet(f"{tmp_path}/in")
        changes = lifecycle.lifecycle(stream, "user", "at", {"status": "string"}, time="ts", late="100 seconds", idle_ms=60_000)
        lifecycle.followed(changes, f"{path}/table", f"{path}/state").awaitTermination()
        found = {r.user: (r.at, r.status, r.final) for r in upserts.current(spark, f"{path}/table", "user long, at long, status string, final boolean", "user", "at").collect()}
        assert found[1][:2] == ((1, "new") if k == 0 else (3, "done")) and found[2][:2] == (2, "new")
    assert found == {1: (3, "done", True), 2: (2, "new", True), 3: (10, "done", False)}


def test_nearest_with_zeros_and_hot_vectors(spark, monkeypatch):
    r = np.random.default_rng(3)
    centers = r.normal(size=(20, 8))
    m = centers[r.integers(0, 20, 1500)] + 0.05 * r.normal(size=(1500, 8))
    m[100:600], m[[5, 50, 77, *range(1000, 1010)]] = m[100], 0
    monkeypatch.setattr(vectors, "SLICE_ROWS", 70)
    rows = [(k, k % 7, None if k == 77 else m[k].tolist()) for k in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(5)
    asked = [*range(0, 1500, 50), 5, 77]
    found = sorted((x.query_id, x.rank, x.vec_id, x.score) for x in vectors.nearest(df.where(F.col("vec_id").isin(asked)), df).select("query_id", F.col("rank"), "vec_id", "score").toPandas().itertuples())
    units, want = m / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-300), []
    for i in sorted({*asked}):
        scores = np.round(units[i] @ units.T, 6) + 0.0
        scores[i] = -9
        want += [(i, k + 1, int(j), float(scores[j])) for k, j in enumerate(np.lexsort((np.arange(1500), -scores))[:10])]
    assert found == want
    # Few rows, fewer than are asked for; none.
    few = df.where("vec_id IN (1, 5, 9)")
    assert sorted((x.query_id, x.vec_id) for x in vectors.nearest(few, few).collect()) == [(1, 5), (1, 9), (5, 1), (5, 9), (9, 1), (9, 5)]
    assert vectors.nearest(df.where("false"), few).count() == 0 and vectors.nearest(few, df.where("false")).count() == 0


def test_cells_prune(spark):
    """In clusters most cells can't hold a neighbour: few products are computed."""
    r = np.random.default_rng(4)
    centers = r.normal(size=(40, 16))
    m = centers[r.integers(0, 40, 2000)] + 0.03 * r.normal(size=(2000, 16))
    df = spark.createDataFrame([(k, 0, m[k].tolist()) for k in range(2000)], "vec_id long, label int, embedding array<double>")
    table, own = vectors.cells(df, 16)
    queries = df.where("vec_id % 50 = 0")
    one = vectors.top(vectors.scored(vectors.visits(queries, own, 16, 10, True), table, spark.createDataFrame([(c, own.slices(c)) for c in range(-1, len(own.pivots))], "cell int, slices int"), 16, 10), 10)
    least = one.groupBy(F.col("query_id").alias("vec_id")).agg(F.min("score").alias("least"))
    later = vectors.visits(queries.join(least, "vec_id"), own, 16, 10, False)
    visited = [r.cell for r in later.collect()] + [r.cell for r in vectors.visits(queries, own, 16, 10, True).collect()]
    assert sum(int(own.rows[c]) for c in visited) < 0.2 * 40 * 2000


def test_medians_by_counting(spark):
    r = random.Random(5)
    rows = [(k % 23, r.choice([None, r.randrange(256)]), r.randrange(256), 255 if k % 2 else 0) for k in range(3000)] + [(99, None, 4, 5)]
    found = {x.g: (x.a, x.b, x.c) for x in blocks.counted_medians(spark.createDataFrame(rows, "g int, a int, b int, c int").repartition(4), ["g"], ["a", "b", "c"]).collect()}
    middle = lambda v: int(np.floor(np.median(v))) if v else None
    assert found == {g: tuple(middle([x[k] for x in rows if x[0] == g and x[k] is not None]) for k in (1, 2, 3)) for g in {x[0] for x in rows}}


def test_overlaps_on_a_grid(spark):
    r = random.Random(6)
    box = lambda wide: (x := r.uniform(-200, 800), y := r.uniform(-50, 900), x + r.choice([-5, 0, 3, wide]), y + r.choice([0, 12, 150]))
    bs, rs = [("f", r.randrange(2), k, 0, *box(300)) for k in range(250)] + [("f", 1, 999, 0, None, None, None, None), ("f", 1, 1000, 0, 72.0, 72.0, 144.0, 144.0)], [("f", r.randrange(2), *box(90)) for _ in range(250)] + [("f", 1, 72.0, 72.0, 144.0, 144.0)]
    df = spark.createDataFrame(bs, "file_id string, page_num int, doc_id long, seq int, x0 double, y0 double, x1 double, y1 double")
    rects = spark.createDataFrame(rs, "file_id string, page_num int, rx0 double, ry0 double, rx1 double, ry1 double")
    found = sorted((x.doc_id, round(x.area, 6), round(x.shared, 6)) for x in sequences.overlaps(df, rects, ["doc_id", "seq"]).collect())
    want, gone = [], set()
    for _, page, d, _, x0, y0, x1, y1 in bs:
        for _, other, a0, b0, a1, b1 in rs:
            if page == other and x0 is not None and x1 > x0 and y1 > y0:
                w, h = min(x1, a1) - max(x0, a0), min(y1, b1) - max(y0, b0)
                if w > 0 and h > 0:
                    want.append((d, round((x1 - x0) * (y1 - y0), 6), round(w * h, 6)))
                    gone |= {d} if w * h > 0.85 * (x1 - x0) * (y1 - y0) else set()
    assert found == sorted(want) and len(want) > 90 and 1000 in gone
    assert {x.doc_id for x in sequences.covered(df, rects).collect()} == {b[2] for b in bs} - gone


def test_numbers_over_many_tasks(spark, monkeypatch):
    df = spark.range(0, 5000, 1, 6).select(F.sha1(F.col("id").cast("string")).alias("path"), "id")
    found = registry.progress(df)
    want = sorted(r.path for r in df.collect())
    assert {r.path: r.label for r in found.collect()} == {p: f"[{k + 1}/5000]" for k, p in enumerate(want)}
    plan = found._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "hashpartitioning(_range" in plan
    monkeypatch.setattr(registry, "written", lambda df: df)
    ranges = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    assert f"rangepartitioning(path ASC NULLS FIRST, {ranges})" in re.sub("#[0-9]+", "", registry.numbered(df, "path")._jdf.queryExecution().toString())
    assert registry.progress(df.where("false")).count() == 0


def test_the_last_of_repeated_rows_stays(spark):
    new = spark.createDataFrame([(1, "a", 5), (1, "z", 2), (1, "b", 5), (2, None, 1), (None, "n", 1), (None, "m", 3)], "k int, v string, at int").repartition(3)
    old = spark.createDataFrame([(1, "old", 0), (3, "old", 0)], "k int, v string, at int")
    assert sorted(map(tuple, registry.upserted(old, new, "k", "at").collect()), key=repr) == sorted([(1, "b", 5), (2, None, 1), (None, "m", 3), (3, "old", 0)], key=repr)
    assert {tuple(r) for r in registry.last_by_key(new.select("k"), "k").collect()} == {(1,), (2,), (None,)}


def test_packed_documents(spark, tmp_path):
    rows = [(f"d/{k:04d}", bytes([k % 256]) * (k % 700)) for k in range(1000)] + [("empty", b""), ("none", None)]
    df, path = spark.createDataFrame(rows, "name string, content binary").repartition(3), f"file://{tmp_path}/p"
    packed.write_packed(df, path, container_bytes=50_000)
    want = {n: c or b"" for n, c in rows}
    assert {r.name: bytes(r.content) for r in packed.read_packed(spark, path).collect()} == want
    assert {r.name: bytes(r.content) for r in packed.read_packed(spark, path, "d/0501", "nothing").collect()} == {"d/0501": want["d/0501"]}
    total = sum(map(len, want.values()))
    assert total / 51_000 <= len(os.listdir(tmp_path / "p/data")) <= total / 50_000 + 3  # files grow with the bytes
    packed.write_packed(df.limit(3), path)
    assert packed.read_packed(spark, path).count() == 3
    packed.write_packed(df.where("false"), path)
    assert packed.read_packed(spark, path).count() == 0


def test_listing_in_tasks(spark, tmp_path):
    want = {}
    for a in range(4):
        for b in range(5):
            (tmp_path / f"in/{a}/x {b}/deep/er").mkdir(parents=True)
            for name, size in ((f"in/{a}/top.pdf", a), (f"in/{a}/x {b}/deep/er/f.pdf", 0), (f"in/{a}/x {b}/%41é.pdf", b + 1)):
                (tmp_path / name).write_bytes(b"z" * size)
                want[f"{tmp_path}/{name}"] = size
    for least in (1, 3, 12, 1000):
        found = files.listed(spark, f"file://{tmp_path}/in", least)
        assert {re.sub("^file:/+", "/", r.path): r.length for r in found.collect()} == want and found.count() == len(want)
    heads = files.with_heads(files.listed(spark, f"file://{tmp_path}/in")).collect()
    assert {len(r.head) for r in heads} == {0, 1, 2, 3, 4, 5}
    assert files.listed(spark, f"{tmp_path}/in/0/top.pdf").count() == 0 and store.listing(f"{tmp_path}/in/0/top.pdf") == [(f"{tmp_path}/in/0/top.pdf", 0)]


def test_pages_of_white_space_are_scanned(spark):
    pages = [("blank", 1, "\n" * 200), ("ideographic", 1, "　" * 200), ("text", 1, " " + "x" * 150 + "\n"), ("short", 1, "x" * 149), ("null", 1, None)]
    found = {r.file_id: r.scanned for r in files.scanned(spark.createDataFrame(pages, "file_id string, page_num int, text string")).collect()}
    assert found == {"blank": True, "ideographic": True, "text": False, "short": True, "null": True}


def test_frequencies_are_those_of_the_spans(spark):
    texts = ["Article 21A and the Finance Act, 1994 by RBI in 1994", "Article 5 of the Companies Act, 2013", "", None, "nothing here"]
    df = entities.with_entities(spark.createDataFrame([(t,) for t in texts], "text string"))
    compiled = [(label, re.compile(p)) for label, p in entities.P.ENTITIES]
    want = defaultdict(int)
    for t in texts:
        for e in entities.spans(t or "", compiled):
            want[e["label"]] += 1
    assert {r.label: r.mentions for r in entities.frequencies(df).collect()} == want and want


def test_queries_keep_and_drop_rows(spark):
    data = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(data):
        pytest.skip("no tables")
    whole = catalog.lines(spark, data).count()
    assert 0 < catalog.QUERIES["covered_blocks"](spark, data).count() < whole
    assert {r.scanned for r in catalog.QUERIES["scan_type"](spark, data).collect()} == {True, False}


def test_queries_of_chunks(spark):
    texts = [
        ("the Polity and its Source", 0), ("Source alone", None), ("Kingship", 1), ("a Viking", 1), ("Taxation", 2), ("TAX", 2), ("an Epic", 3), ("Mahabharata and Svara or accent", 3),
        ("Sanskrit language", 4), ("Dichotomy of Veda", 5), ("it is divided into", 5), ("Vedavyasa", 6), ("a heap", 6), ("Vedic, Epic and Puranic culture", 3), ("", None), (None, None),
    ]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "place long, text string")
    found = {r.place: r.q for r in df.select("place", vectors.synthesized(F.col("text")).alias("q")).collect()}
    queries = [q for _, q in catalog.P.QUERY_RULES]
    assert [found[k] for k in range(len(texts))] == [None if rule is None else queries[rule] for _, rule in texts]
    first = {}
    for k, (_, rule) in enumerate(texts):
        if rule is not None:
            first.setdefault(queries[rule], k)
    assert {r.query: r.expected for r in vectors.asked(df, "place").collect()} == first
    plain = df.where("text = 'Source alone' OR text = '' OR text IS NULL")
    assert [tuple(r) for r in vectors.asked(plain, "place").collect()] == [(catalog.P.DEFAULT_QUERIES[0], 1), (catalog.P.DEFAULT_QUERIES[1], 14)]
    assert [r.expected for r in vectors.asked(plain.where("place = 1"), "place").collect()] == [1, 1] and vectors.asked(plain.where("false"), "place").count() == 0
    # A chunk that is its query's own words comes first; one without a word of it isn't found.
    words = spark.createDataFrame([(1, f"{queries[1]} king"), (2, "nothing of it"), (3, "zz Taxation zz")], "place long, text string")
    ranks = {r.query: r["rank"] for r in vectors.retrieved(words, vectors.asked(words, "place"), vectors.embedded).collect()}
    assert ranks[queries[1]] == 1 and set(ranks) == {queries[1], queries[2]}
    measured = vectors.measures(vectors.retrieved(words, vectors.asked(words, "place").where("expected = 1"), vectors.embedded)).first()
    assert (measured.queries, measured.mrr, measured.recall5) == (1, 1.0, 1.0)


def test_report_in_sections(spark, tmp_path):
    shape = "file_id string, total_blocks long, content_blocks long, corrected_blocks long, entity_count long, coverage_pct double, passed int, score double, rating string, ready boolean, issues string"
    rows = [("b/1", 10, 8, 2, 3, 100.0, 9, 95.0, "Excellent", True, ""), ("a/2", 5, 5, 0, 1, 50.0, 8, 60.0, "Fair", False, "Completeness (High), Continuity (Low)"), ("c", 0, 0, 0, 0, 0.0, 0, 0.0, "Poor", False, "Completeness (High)")]
    found = audit.sections(spark.createDataFrame(rows, shape))
    lines = defaultdict(list)
    for r in found.orderBy("part", "place").collect():
        lines[r.part].append(r.line)
    assert lines[1] == ["Files: 3", "Mean confidence: 51.7%", "Mean coverage: 50.0%", "Ready: 1 of 3 (33.3%)", "Blocks: 15, content: 13, corrected: 2", "Entities: 4"]
    assert lines[2] == ["| Excellent | 1 | 33.3% |", "| Good | 0 | 0.0% |", "| Fair | 1 | 33.3% |", "| Poor | 1 | 33.3% |"]
    assert lines[3] == ["| Completeness (High) | 2 |", "| Continuity (Low) | 1 |"]
    assert lines[4] == ["| 1 | a/2 | 50.0% | 8/9 | 60.0% | Fair | no |", "| 2 | b/1 | 100.0% | 9/9 | 95.0% | Excellent | yes |", "| 3 | c | 0.0% | 0/9 | 0.0% | Poor | no |"]
    audit.write_report(found, f"file://{tmp_path}/report")
    text = "".join((tmp_path / "report" / f).read_text() for f in sorted(os.listdir(tmp_path / "report")) if f.startswith("part"))
    assert text.splitlines() == [x for part, head in ((1, "# Summary"), (2, "# Ratings"), (3, "# Issues"), (4, "# Files")) for x in (head, *lines[part])]
    empty = {(r.part, r.place): r.line for r in audit.sections(spark.createDataFrame([], shape)).collect()}
    assert empty[1, 0] == "Files: 0" and empty[1, 3] == "Ready: 0 of 0 (0.0%)" and len(empty) == 10


def test_markers_stand_after_their_page(spark):
    rows = [("f", 1, 0, 0, "paragraph", "x", False), ("f", 2, 1, 0, "header", "h", None), ("f", 2, 1, 1, "paragraph", "b", True), ("f", 4, 2, 0, "paragraph", "y", None), ("g", 7, 3, 0, "footer", "z", False)]
    df = spark.createDataFrame(rows, "file_id string, page_num int, doc_id long, seq int, type string, text string, is_boilerplate boolean")
    found = [(r.file_id, r.page_num, r.type, r.doc_id) for r in sequences.with_blank_markers(df).orderBy("file_id", "position").collect()]
    assert found == [("f", 1, "paragraph", 0), ("f", 2, "header", 1), ("f", 2, "paragraph", 1), ("f", 2, "blank_page", None), ("f", 4, "paragraph", 2), ("g", 7, "footer", 3), ("g", 7, "blank_page", None)]


def test_boxes_and_sources_of_answers(spark):
    raw = '[{"text": "a", "bbox": [1, 2.5, 3, 4]}, {"text": "b"}, {"text": "c", "bbox": null}]'
    df = spark.createDataFrame([(5, 12, raw)], "doc_id long, page int, raw string")
    found = files.normalized_blocks(df, "raw", "page", "other").orderBy("block_no").collect()
    assert [(r.block_id, r.page_num, r.bbox, r.was_corrected, r.entities, r.source) for r in found] == [
        ("blk_p0012_001", 12, [1.0, 2.5, 3.0, 4.0], False, [], "other"), ("blk_p0012_002", 12, [0.0, 0.0, 612.0, 792.0], False, [], "other"), ("blk_p0012_003", 12, [0.0, 0.0, 612.0, 792.0], False, [], "other"),
    ]


def test_whole_documents(spark):
    blocks_ = [("f", 1, 0, 0, "paragraph", "x", False, True, ["e"]), ("f", 2, 1, 0, "footer", "2", True, None, None), ("g", 1, 3, 0, "paragraph", "y", None, False, ["a", "b"])]
    df = spark.createDataFrame(blocks_, "file_id string, page_num int, doc_id long, seq int, type string, text string, is_boilerplate boolean, was_corrected boolean, entities array<string>")
    named = spark.createDataFrame([("f", "f.pdf", "t"), ("g", "g.pdf", "t")], "file_id string, file_name string, extracted_at string")
    tables = spark.createDataFrame([("f", 2, "tbl_002", "", ["h"], [["a"], ["b"]], 2, 1), ("f", 1, "tbl_001", "c", ["h"], [["z"]], 1, 1)], "file_id string, page_num int, table_id string, caption string, headers array<string>, rows array<array<string>>, row_count int, column_count int")
    images = spark.createDataFrame([("g", 1, "p1.png")], "file_id string, page_num int, filename string")
    found = {r.file_id: json.loads(r.document) for r in files.assembled(df, named, tables, images).collect()}
    assert found["f"]["extraction_summary"] == {"total_blocks": 2, "content_blocks": 1, "boilerplate_blocks": 1, "corrected_blocks": 1, "total_ner_entities": 1, "table_count": 2, "image_count": 0}
    assert [t["table_id"] for t in found["f"]["tables"]] == ["tbl_001", "tbl_002"] and found["f"]["page_images"] == [] and found["f"]["tables"][1]["rows"] == [["a"], ["b"]]
    assert found["g"]["page_images"] == [{"page_num": 1, "filename": "p1.png"}] and found["g"]["tables"] == [] and found["g"]["extraction_summary"]["total_ner_entities"] == 2
    plain = {r.file_id: json.loads(r.document) for r in files.assembled(df.drop("entities"), named).collect()}
    assert plain["f"]["extraction_summary"]["table_count"] == 0 and plain["f"]["tables"] == []


def test_rounding_by_the_binary_value(spark):
    r = random.Random(7)
    values = [2.675, 2.665, 0.125, 0.375, 2.5, 3.5, -2.5, 1.005, 0.285, 95.85, 66.67, 33.335, 1e17, -0.045, 0.0, 5e-324, 1.5e15, 99.95, 0.15, 0.25, 0.35, float("inf"), 52.25, 4503599627370497.5]
    values += [r.uniform(-1000, 1000) for _ in range(5000)] + [round(r.uniform(0, 100), 3) for _ in range(5000)] + [r.randrange(10**6) / 8 for _ in range(2000)] + [(2 * r.randrange(10**5) + 1) / 200 for _ in range(5000)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    for digits in (0, 1, 2, 3):
        found = {x.k: x.y for x in df.select("k", T.half_even(F.col("v"), digits).alias("y")).collect()}
        assert [found[k] for k in range(len(values))] == [v if v == float("inf") else round(v, digits) for v in values]
    assert spark.range(1).select(T.half_even(F.lit(None), 1).alias("y")).first().y is None
    duckdb = pytest.importorskip("duckdb")
    few = values[:21] + values[22:3000]
    rows = duckdb.connect().execute(f"SELECT {sql.rounded('x', 2)} FROM (SELECT unnest(?::DOUBLE[]) AS x)", [few]).fetchall()
    assert [x for (x,) in rows] == [round(v, 2) for v in few]


def test_replacing_by_an_automaton():
    rules = [*T.P.DOMAIN_TERMS, *T.P.CONFUSIONS, *T.P.SPLIT_WORDS]
    own, r = T.Replacer(rules), random.Random(8)
    parts = ["thal", "il", "lo", "V  ol.", "V\nolume", "S hah", "U.P.S.C.a", "C.E.", "B.C.E.x", "MIDDLEeastern", "easten", "easte'n", "Sull kut", "{ho", "cial", "é", "_", " ", " ", "-", "x", "SOCIAL SCIENCE - PART 1 ", "Perso  -  Islamic", "thls", "I'he"]
    for _ in range(3000):
        text = want = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        for p, to in rules:
            want = re.sub(p, to, want)
        assert own.replaced(text) == want
    # What a replacement makes can be another pattern's word.
    chain = T.Replacer([("ab", "cd"), ("cde", "fg"), ("ab", "never"), (r"\bfg\b", "done")])
    assert chain.replaced("abe") == "done" and chain.replaced("xabe") == "xfg" and chain.replaced("") == ""
    with pytest.raises(ValueError):
        T.Replacer([(r"\d+", "x")])


def test_what_each_match_holds(spark):
    cases = {r"(?i)all\s+rights?\s+reserved": "reserved", r"(?i)www\.[a-z0-9\-]+\.[a-z]{2,}": "www.", r"(?i)https?://[a-z]+\.jstor\.org/stable/": ".jstor.org/stable/", r"\.{4,}\s*\d+\s*$": "", "a|bc": "", "x(ab|c)+de?f": "x", "ab+c": "ab", r"[\]ab]cd": "cd", r"(?i)call\s*/?s*whatsapp\s*:": "whatsapp"}
    assert {p: T.core(p) for p in cases} == cases
    lists = (T.P.COPYRIGHT, T.P.BIBLIOGRAPHY, T.P.TOC, T.P.HEADER, T.P.FOOTER, T.P.HEADINGS)
    lines = ["All Rights reserved", "COPYRIGHT (c) 2001", "for internal  use only", "Do not copy", "no part of this document may be", "see WWW.a-b.in now", "e-mail: x", "email: a@b", "call s whatsapp: +91 98765 43210", "Contact: +91 98765 43210", "HTTPS://DOI.org/1", "x http://abc.JSTOR.org/stable/", "Modern  Asian Studies", "the journal of asian studies.", "Doe, Jane. 2001.", "a ..... 7", "reserved", "Chapter 3", "", "not", "İ www.é"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "k int, t string")
    for patterns in lists:
        found = df.select("k", T.matches(F.col("t"), patterns).alias("a"), F.col("t").rlike(T.P.any_of(patterns)).alias("b")).collect()
        assert [r.k for r in found if r.a] == [r.k for r in found if r.b]


def test_chunks_of_a_long_document(spark):
    """100,000 blocks of one document, in seconds; each block is in a chunk, chunks overlap by the end of the one before."""
    df = spark.range(100_000).select(F.lit("f").alias("file_id"), (F.col("id") / 1000).cast("int").alias("page_num"), F.lit(0).cast("long").alias("doc_id"), F.col("id").cast("int").alias("seq"), F.concat(F.lit(" some words of line "), F.repeat(F.lit("w"), 60), F.col("id").cast("string")).alias("text"))
    found = chunks.chunks(df).orderBy("chunk_no").collect()
    assert [k for r in found for k in r.block_ids] == [*range(100_000)] and len(found) > 9000
    assert all(b.text.startswith(a.text[-200:].strip()) and b.character_count <= 1300 for a, b in zip(found, found[1:]))
    assert [c["text"] for c in chunks.fold([{"seq": k, "text": t, "page_num": None} for k, t in enumerate(["ab", "c d", "efgh"])], 4, 2)] == ["ab", "c d", "d efgh"]
    assert chunks.fold([], 4, 2) == [] and [c["text"] for c in chunks.fold([{"seq": 0, "text": "abcdef", "page_num": 3}, {"seq": 1, "text": "g", "page_num": 2}], 4, 0)] == ["abcdef", "g"]
