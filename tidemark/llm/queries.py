"""The registered query of each operator, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import chat, decontaminate, exact, impact, jaccard, language, lexical, lines, pieces, prefix_trie, quality, token_counts, warc


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.held_out_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_curve(_table(spark, folder, "documents"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.per_document(_table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.report(_table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.held_out_predictions(_table(spark, folder, "documents"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.label(_table(spark, folder, "documents"))


def op9_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, folder, "documents"))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digest(chat.rotate(_table(spark, folder, "conversations")))


def op11_topk(spark: SparkSession, folder: str) -> DataFrame:
    return impact.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.shared(_table(spark, folder, "conversations"))


QUERIES = {q.__name__: q for q in (
    op1_decontaminate, op2_quality, op3_token_counts, op4_sentencepiece, op5_line_dedup, op6_language, op7_warc, op8_exact_dedup,
    op9_ngram_jaccard, op10_chat_format, op11_topk, op12_lexical, op13_prefix_trie)}
ORACLE = {
    "op7_warc": warc.ORACLE, "op8_exact_dedup": exact.ORACLE, "op9_ngram_jaccard": jaccard.ORACLE, "op10_chat_format": chat.ORACLE,
    "op11_topk": impact.ORACLE, "op12_lexical": lexical.ORACLE, "op13_prefix_trie": prefix_trie.ORACLE}
