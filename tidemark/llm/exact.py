"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import cut

PREFIX_CHARS = 256
BROADCAST_PAIRS = 1 << 20


def _content(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def _coarse(text: Column, prefix_chars: int) -> list[Column]:
    return [F.octet_length(text).alias("_length"), F.xxhash64(F.substring(text, 1, prefix_chars)).alias("_prefix")]


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that several rows have; counts are combined before the shuffle, so a hot key is one row a task."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """``(text_sha256, keep_id, group_size)``: a row for each text that several rows share.

    Levels one and two group rows by byte length and, within a length, by the hash of the first ``prefix_chars``
    characters, in one count whose partial sums make a common length or prefix one row a task. Level three hashes
    full contents by SHA-256 of rows whose pair is repeated and no others. While the repeated pairs, which are counted,
    are at most ``BROADCAST_PAIRS``, they go to the tasks and only digests are shuffled; beyond it a join of both
    sides by pair, whose partitions Spark splits where a pair is hot, takes the texts with it.

    Texts are compared as they are, a null text as an empty one. Of equal texts the largest id stays. A repeated
    row is a member like any other. Ids are ignored in choosing ``keep_id`` where they are null.
    """
    coarse = docs.select(*_coarse(_content(text_col), prefix_chars))
    pairs = cut(_repeated(coarse, "_length", "_prefix"), "repeated-pairs")
    if pairs.count() <= BROADCAST_PAIRS:
        pairs = F.broadcast(pairs)
    full = docs.select(F.col(id_col).alias("_id"), _content(text_col).alias("_text"), *_coarse(_content(text_col), prefix_chars))
    hashed = full.join(pairs, ["_length", "_prefix"], "left_semi").select("_id", F.sha2("_text", 256).alias("text_sha256"))
    return (
        hashed.groupBy("text_sha256").agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per given row: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    A text no other row has keeps its own row. ``kept`` is true for the row (each row, if repeated with the same id)
    that stays; in a group whose ids are all null every row stays, as none can be told apart. Other columns are not
    looked at. The digest column is asked for of every row, so a second, map-only pass writes it; only ids and
    digests of that pass are shuffled.
    """
    groups = duplicate_groups(docs, id_col, text_col, prefix_chars)
    rows = docs.select(F.col(id_col).alias("_id"), F.sha2(_content(text_col), 256).alias("text_sha256"))
    found = rows.join(groups, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("_id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("_id").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("_id")).alias("kept"), "text_sha256",
    )


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""
