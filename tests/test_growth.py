"""What a query does mustn't grow faster than its input: bounds on batches, visits, readings and moves."""

import numpy as np
from pyspark.sql import functions as F

from leafworks.functions import text as T
from leafworks.operators import chunks, sequences, vectors
from leafworks.plans import catalog
from leafworks.sources import upserts
from leafworks.streaming import lifecycle


def batch_rows(spark):
    return int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))


def test_chunks_bound_their_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.createDataFrame([(k, n, f"line {n}") for k in range(30) for n in range(3)], "doc_id long, seq int, text string").withColumn("file_id", F.lit("f"))
    assert chunks.chunks(df).count() == 30 and batch_rows(spark) <= 1024


def test_correction_bounds_its_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = spark.range(5).select(T.basic_correction(F.concat(F.lit("thls "), F.col("id").cast("string"))).alias("t"))
    assert found.count() == 5 and batch_rows(spark) <= 1024


def test_cells_are_large_enough_for_their_visits(spark, monkeypatch):
    monkeypatch.setattr(vectors, "FEW_PIVOTS", 8, raising=False)
    monkeypatch.setattr(vectors, "CELL_ROWS", 400, raising=False)
    m = np.random.default_rng(2).normal(size=(2000, 16))
    df = spark.createDataFrame([(k, 0, m[k].tolist()) for k in range(2000)], "vec_id long, label int, embedding array<double>").repartition(3)
    queries = df.where("vec_id % 50 = 0")
    _, own = vectors.cells(df, 16)
    assert len(own.pivots) <= 8
    least = queries.withColumn("least", F.lit(-1.0))
    assert vectors.visits(queries, own, 16, 10, True).count() + vectors.visits(least, own, 16, 10, False).count() <= 8 * 40
    units = m / np.linalg.norm(m, axis=1, keepdims=True)
    found = {(x.query_id, x["rank"]): (x.vec_id, x.score) for x in vectors.nearest(queries, df).collect()}
    for q in range(0, 2000, 50):
        scores = np.round(units @ units[q], 6)
        order = [j for j in np.lexsort((np.arange(2000), -scores)) if j != q][:10]
        assert [found[q, n + 1] for n in range(10)] == [(j, scores[j]) for j in order]


def test_retrieval_encodes_each_chunk_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def encode(df, text):
        def run(t):
            seen.add(1)
            return [float(len(t)), 1.0]

        return df.withColumn("vector", F.udf(run, "array<double>")(F.col(text)))

    words = spark.createDataFrame([(k, f"chunk {k} of a text") for k in range(60)], "place long, text string").repartition(3)
    queries = spark.createDataFrame([("a query", 5)], "query string, expected long")
    assert vectors.retrieved(words, queries, encode).count() == 1
    assert seen.value < 60 + 10


def test_fences_look_at_a_costly_text_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def costly(k):
        seen.add(1)
        return [" ```json\n[1]\n``` ", "```x```", "``` \n\n a ```", "plain"][k % 4]

    found = spark.range(40).select("id", T.without_fences(F.udf(costly, "string")(F.col("id").cast("int"))).alias("t"))
    assert {r.t for r in found.collect()} == {"[1]", "```x", "a", "plain"}
    json = F.concat(F.lit("```json\n"), F.to_json(F.array(F.col("id"))), F.lit("\n```"))
    assert spark.range(3).select(T.without_fences(json))._jdf.queryExecution().optimizedPlan().toString().count("to_json") == 1


def moves(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_blocks_of_whole_files_move_once(spark, tmp_path):
    spark.createDataFrame([(k, f"s{k % 3}", f"a line {k % 7}\nanother one {k}", "en") for k in range(200)], "doc_id long, source string, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("boilerplate_tag", "blank_marked"):
        found = catalog.QUERIES[name](spark, str(tmp_path))
        assert moves(found) == 1 and found.count() > 800


def test_page_dedup_moves_files_once(spark):
    words = [" ".join(f"w{(k // 3) * 20 + n}" for n in range(20)) for k in range(30)]
    df = spark.createDataFrame([("f", k, words[k]) for k in range(30)] + [("g", 0, words[0]), ("g", 1, "short")], "file_id string, page_num long, text string")
    found = sequences.page_dedup(df, ["topic"])
    assert {(r.file_id, r.page_num) for r in found.collect()} == {("f", k) for k in range(0, 30, 3)} | {("g", 0), ("g", 1)}
    assert moves(sequences.page_dedup(df, ["topic"])) == 1


def test_lifecycle_without_timers_calls_no_python(spark, tmp_path):
    shape, path, big = "k long, at long, n long, x double", f"file://{tmp_path}", 2**53 + 1
    for rows in ([(1, 1, big, 1.0), (1, 2, None, float("nan"))], [(1, 0, 7, 2.0), (2, 5, None, None)]):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    changes = lifecycle.lifecycle(stream, "k", "at", {"n": "long", "x": "double"})
    plan = changes._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan
    lifecycle.followed(changes, f"{path}/table", f"{path}/state").awaitTermination()
    found = upserts.current(spark, f"{path}/table", f"{shape}, final boolean", "k", "at").collect()
    assert {r.k: (r.at, r.n, str(r.x), r.final) for r in found} == {1: (2, big, "nan", False), 2: (5, None, "None", False)}


def test_upserts_take_a_stream_of_plain_rows(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string").coalesce(1).write.parquet(f"{tmp_path}/in")
    spark.dataSource.register(upserts.UpsertSink)
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema("k long, v string").parquet(f"{tmp_path}/in")
        stream.writeStream.format("upserts").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/table").awaitTermination()
    assert sorted(map(tuple, upserts.current(spark, f"{tmp_path}/table", "k long, v string", "k").collect())) == [(1, "a"), (2, "b")]
