"""The corpus pipeline: toxicity, quality rules, line dedup, near dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of documents. A
stage judges its own input, which is all that its predecessor kept, whole. Rows with a null doc_id pass through
every stage like others; other columns are handed on and never looked at, whatever their names. Empty tables pass
through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafworks.llm import line_dedup, near_dedup, packing, quality, toxicity
from leafworks.llm.queries import training_fold
from leafworks.llm.shared import discard, scratch_of, written

TOXIC_FROM = 0.5


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs but for the rows whose doc_id is in ids, null included; the texts of others stay where they are read."""
    a, b = F.xxhash64("doc_id"), F.xxhash64("doc_id", F.lit(1))
    gone = written(ids.select(a.alias("a"), b.alias("b")).distinct())
    return line_dedup.without_keys(docs, gone, a, b, docs.select("doc_id"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of TOXIC_FROM or more go.

    Null and empty texts, and texts without a feature, score the rate of toxic examples among such texts. A score
    that is just TOXIC_FROM goes. Rows that repeat a doc_id go together if one of them is toxic; rows without a
    doc_id likewise. Texts of any length are scored whole. Without labels nothing goes.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = toxicity.scores(docs, labels, training_fold())
    return without(docs, found.where(F.col("score") >= TOXIC_FROM))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go, row by row.

    Null and empty texts go: they have fewer than 20 words. Each row is judged by its own text, so rows that repeat a
    doc_id may part, and repeated rows share their fate. A share that is just a rule's limit stays. Texts of any
    length are looked at whole, in one row.
    """
    return quality.accepted(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines leave the texts; n_chars follows. Documents stay, also when no line is left.

    A null text becomes an empty one. Of the documents that hold a line the largest doc_id keeps it; rows that repeat
    that doc_id all do, and a null doc_id comes before all others. Texts of any length are read whole.
    """
    found = line_dedup.line_dedup(docs)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays.

    Null, empty and blank texts are in no group and stay. Rows that repeat a doc_id share its group and its fate, so
    repeated rows of the smallest doc_id all stay; rows without a doc_id stay. Texts of any length count whole.
    """
    return without(docs, near_dedup.near_duplicates(docs).where(~F.col("kept")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the packed sequences.

    A null or empty text is the end id alone. Rows that repeat a doc_id, or have none, are packed like any other.
    Pieces of one length may change places. Longer texts are cut, into whole sequences but for the first piece.
    """
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(docs, *paths, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]
#: SQL can't express the classifier's nearest examples or the packing; test_pipeline_stages_against_plain_computations
#: holds every stage against a plain computation on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of sf_dir, each result written before the next stage reads it. What a stage
    has written besides, and the result before it, are deleted then; the last stage's remains are read by the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before = docs
        with scratch_of(lambda: docs):  # noqa: B023
            docs = written(stage(spark, before, sf_dir))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
