"""Bytes of whole Arrow batches as numpy arrays, and hashed n-gram histograms of them.

Work is done in blocks of bounded size whatever the length of a text: a block takes many short texts or a stretch
of a long one, and n-grams that start in a stretch may end beyond it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.session import share_code

BLOCK_BYTES = 1 << 18
BATCH_BYTES = 8 << 20
_A, _B = np.uint32(2654435761), np.uint32(2246822519)


def map_batches(rows: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, as a number of rows bounds nothing where texts are long."""
    share_code(rows.sparkSession)
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return rows.mapInArrow(run, schema)


def byte_table(lower: bool = True) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    return table


LOWER = byte_table()


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, bytes)`` of a string column; null texts are empty."""
    if pa.types.is_large_string(texts.type) or pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return starts, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def row_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes in all; a longer row is a range of its own."""
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def histograms(texts: pa.Array, orders: tuple[int, ...], width: int, block: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(first row, end row, counts)`` with ``width`` hashed buckets for each order of byte n-gram, side by side.

    ASCII letters count in lower case. An n-gram never spans two texts.
    """
    offsets, data = flat(texts)
    rows = max(1, (64 << 20) // (4 * width * len(orders)))
    for lo, hi in row_blocks(offsets, block):
        for a in range(lo, hi, rows):
            b = min(hi, a + rows)
            counts = np.zeros((b - a, len(orders) * width), np.float32)
            for at in range(int(offsets[a]), int(offsets[b]), block):
                end = min(int(offsets[b]), at + block)
                _add(counts, offsets[a : b + 1], data, at, end, orders, width)
            yield a, b, counts


def _add(counts: np.ndarray, offsets: np.ndarray, data: np.ndarray, at: int, end: int, orders: tuple[int, ...], width: int) -> None:
    chars = LOWER[data[at : min(int(offsets[-1]), end + max(orders) - 1)]].astype(np.uint32)
    edges = np.clip(offsets, at, end)
    base = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64) * counts.shape[1], np.diff(edges))
    spare = counts.size
    for k, order in enumerate(orders):
        size = min(end - at, len(chars) - order + 1)
        if size <= 0:
            continue
        code = chars[:size].copy()
        for i in range(1, order):
            code *= _A
            code += chars[i : i + size]
        code *= _B
        code >>= np.uint32(32 - width.bit_length() + 1)
        key = base[:size] + code
        key += k * width
        for i in range(1, order):  # starts too near to the end of their text
            short = offsets[1:] - i
            key[short[(short >= np.maximum(offsets[:-1], at)) & (short < at + size)] - at] = spare
        counts += np.bincount(key, minlength=spare + 1)[:spare].reshape(counts.shape)


def features(counts: np.ndarray, parts: int) -> np.ndarray:
    """Square roots of shares, of unit length for each order; an empty text has only zeros."""
    shaped = counts.reshape(len(counts), parts, -1)
    total = shaped.sum(2, keepdims=True)
    return np.sqrt(np.divide(shaped, total, out=np.zeros_like(shaped), where=total > 0)).reshape(len(counts), -1)


def sparse(counts: np.ndarray) -> list[dict]:
    """Rows as ``(bucket, count)`` lists."""
    out = []
    for row in counts:
        at = np.flatnonzero(row)
        out.append({"at": at.astype(np.int32), "n": row[at]})
    return out
