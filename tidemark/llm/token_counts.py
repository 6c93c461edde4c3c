"""Exact length histogram of encoded documents, with suffix sums for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.grams import map_batches
from tidemark.session import cut

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern that belongs to the vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 1024


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _counter(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            lengths = [len(encode(text.as_py())) if text.is_valid else 0 for text in batch.column("_text")]
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(lengths, pa.int64())], names=[*batch.schema.names[:-1], "length"])

    return run


def encoded_lengths(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and ``length``: how many ids each whole text has. Null and empty texts have 0; strings of
    special tokens are ordinary text. ``vocabulary`` is a file of base64 pieces and ranks that every executor can read."""
    kept = docs.select(*(F.col(name) for name in keep), F.col(text_col).alias("_text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    return map_batches(kept, _counter(vocabulary), ", ".join([*kinds, "length long"]))


def histogram(lengths: DataFrame, length_col: str = "length") -> DataFrame:
    """``(length, n_docs)``; documents of a length are counted before the shuffle."""
    return lengths.groupBy(F.col(length_col).alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """The histogram with what answers every question about a context limit of ``length`` tokens.

    ``n_tokens`` of the documents that long; ``docs_at_least`` and ``tokens_at_least`` of those this long or longer;
    ``total_docs`` and ``total_tokens`` of all; ``truncated_tokens``, what remains if each document is cut to this
    limit; ``lost_tokens``, the rest. Sums run inside blocks of lengths and then over the blocks, so a task has
    ``BLOCK`` rows, or a row for each block, whatever the number of documents. An empty table gives no row.
    """
    rows = counts.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), F.floor(F.col("length") / BLOCK).alias("_block"))
    after = Window.partitionBy(F.lit(0)).orderBy(F.col("_block").desc())
    blocks = rows.groupBy("_block").agg(F.sum("n_docs").alias("_docs"), F.sum("n_tokens").alias("_tokens"))
    longer = blocks.select(
        "_block", (F.sum("_docs").over(after) - F.col("_docs")).alias("_docs_after"), (F.sum("_tokens").over(after) - F.col("_tokens")).alias("_tokens_after"),
        F.sum("_docs").over(Window.partitionBy(F.lit(0))).alias("total_docs"), F.sum("_tokens").over(Window.partitionBy(F.lit(0))).alias("total_tokens"),
    )
    inside = Window.partitionBy("_block").orderBy(F.col("length").desc())
    sums = rows.join(longer, "_block").withColumns({
        "docs_at_least": F.sum("n_docs").over(inside) + F.col("_docs_after"), "tokens_at_least": F.sum("n_tokens").over(inside) + F.col("_tokens_after"),
    })
    truncated = F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")
    return sums.select(
        "length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least", "total_docs", "total_tokens",
        truncated.alias("truncated_tokens"), (F.col("total_tokens") - truncated).alias("lost_tokens"),
    )


def quantile(curve: DataFrame, share: float) -> DataFrame:
    """``(length)``: the smallest length that at least ``share`` of the documents do not exceed; from the suffix sums."""
    within = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    return curve.where(within >= F.ceil(F.col("total_docs") * F.lit(share))).agg(F.min("length").alias("length"))


def truncated_total(curve: DataFrame, limit: int) -> DataFrame:
    """``(tokens)`` that remain if each document is cut to ``limit``; any limit, also one no document has as length."""
    head, tail = F.col("length") <= limit, F.col("length") > limit
    return curve.agg(F.coalesce(
        F.sum(F.when(head, F.col("n_tokens"))), F.lit(0)).alias("_within"), F.coalesce(F.sum(F.when(tail, F.col("n_docs"))), F.lit(0)).alias("_over"),
    ).select((F.col("_within") + F.col("_over") * limit).alias("tokens"))


def token_curve(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Every distinct encoded length of the documents with its suffix sums. Repeated rows count as often as they occur.
    Texts are encoded once: the histogram, a row for each length, is written before its sums are taken."""
    return suffix_sums(cut(histogram(encoded_lengths(docs, text_col, (), vocabulary)), "token-counts"))
