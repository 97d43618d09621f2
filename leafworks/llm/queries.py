"""The registered queries of this subpackage: thin wrappers that apply an operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafworks.llm import bpe, chat, exact_dedup, line_dedup, near_dedup, packing, periodic_runs, prefix_bpe, quality, source_audit, token_counts, toxicity, warc
from leafworks.llm.sql import ORACLE_SQL  # noqa: F401

TOKEN_LIMIT = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return counted.select("doc_id", n_bytes.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(table(spark, sf_dir, "documents"), *paths, public_tokenizers.PATTERN)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.measured(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    turns = turns.unionByName(spark.createDataFrame(tricky, "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.format_chats(turns))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def training_fold(key: str = "doc_id") -> Column:
    """The rows of labels that toxicity may learn from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 0


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    found = toxicity.scores(docs, labels, training_fold())
    return found.select("doc_id", (~training_fold()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.with_originals(warc.read_archives(manifest, payloads=False))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.source_audit(table(spark, sf_dir, "documents"))


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.run_digests(docs.select("doc_id", periodic_runs.repeating_tail(F.col("doc_id")).alias("text")))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_line_dedup": op2_line_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_chat_format": op7_chat_format,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_source_audit": op11_source_audit,
    "op12_prefix_bpe": op12_prefix_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}
