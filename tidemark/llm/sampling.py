"""Bounded training samples of feature vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.grams import map_batches


def crc(id_col: str) -> Column:
    """crc32 of the id as text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def thinned(rows: DataFrame, id_col: str, group: str, total: int, most_groups: int = 512) -> DataFrame:
    """About ``total`` rows, evenly over the groups, chosen by hash of the id: a group of n rows gives each with
    probability ``total / groups / n``. The same rows come whatever the partitioning; only counts reach the driver."""
    sizes = {r[group]: r["n"] for r in rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).limit(most_groups + 1).collect()}
    if len(sizes) > most_groups:
        raise ValueError(f"more than {most_groups} groups to learn")
    if not sizes:
        return rows.limit(0)
    share = F.coalesce(*(F.when(F.col(group) == name, F.lit(total / len(sizes) / n)) for name, n in sizes.items()))
    even = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(even < share)


def vectors(rows: DataFrame, text_col: str, group: str, featurize: Callable[[pa.Array], Iterator[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """``(groups, features)`` of a bounded sample, computed by the executors and sent as half-precision rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for x in featurize(batch.column(1)):
                packed = pa.array([row.tobytes() for row in x.astype(np.float16)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(x)), packed], names=[group, "x"])
                done += len(x)

    kind = rows.schema[group].dataType.simpleString()
    got = map_batches(rows.select(group, text_col), run, f"`{group}` {kind}, x binary").toArrow()
    names = np.array(got[group].to_pylist())
    x = [np.frombuffer(b, np.float16) for b in got["x"].to_pylist()]
    order = np.lexsort((np.array([b[:64].tobytes() for b in x]), names)) if len(x) else []
    return names[order], np.array(x, np.float32)[order] if len(x) else np.zeros((0, 0), np.float32)
