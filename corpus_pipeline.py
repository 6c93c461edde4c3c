"""The training-data pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

A stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, jaccard, language, lines, pieces
from tidemark.session import work_dir


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told apart. Texts without a letter and those whose codewords do not decide
    between two languages are rejected. The model learns from the folds that the language query learns from."""
    return language.keep_decided(docs, language.train_on_folds(docs))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; one that loses all its text goes. ``n_chars`` follows the text."""
    done = lines.drop_recurring(docs)
    gone = (F.col("lines_dropped") > 0) & (F.trim(F.col("text")) == "")
    size = {"n_chars": F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {}
    return done.withColumns(size).where(~F.coalesce(gone, F.lit(False))).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of the near-duplicate graph; repeated rows of it are one."""
    return jaccard.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document's text, a row for each chunk of it, and whether they decode to the text."""
    return pieces.encode(docs).select("doc_id", "chunk", "n_chunks", "ids", "n_tokens", "ids_digest", "round_trip")


STAGES = [
    ("language", keep_known_languages),
    ("line_dedup", drop_recurring_lines),
    ("near_copies", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("pieces", encode_pieces),
]

#: Learnt models, templates and a tokenizer have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
