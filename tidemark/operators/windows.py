"""Shares and running totals over already aggregated rows.

Windows without a partition run in one task. They are used only after a
grouping whose number of groups is fixed by the report (day numbers, buckets,
order types), never on source rows; ``running_total`` is for those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import cut


def total(value: Column, partition: Sequence[str] = ()) -> Column:
    """Grand total, or total per partition."""
    return F.sum(value).over(W.partitionBy(*partition))


def running(value: Column, order: str, partition: Sequence[str] = ()) -> Column:
    """Running total; rows with equal order keys are peers and share one value."""
    return F.sum(value).over(W.partitionBy(*partition).orderBy(order))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)`` that no task holds whole.

    Rows are dealt out by ranges of ``keys`` and ``order``, added up within a range, and the totals of a key's earlier
    ranges, few rows, are added. So a key with a third of all rows, or none at all (one total over the table), is many
    tasks. ``order`` is to be unique within a key.
    """
    by = [F.col(c) for c in (*keys, *order)]
    ranged = cut(df.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = W.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = ranged.groupBy(*keys, "_range").agg(F.sum(value).alias("_total"))
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    earlier = totals.select(*(F.col(k).alias(f"_key_{k}") for k in keys), F.col("_range").alias("_of"), F.sum("_total").over(before).alias("_before"))
    earlier = earlier.filter(F.col("_before").isNotNull())
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    added = ranged.withColumn("_inside", F.sum(value).over(inside)).join(earlier, [F.col("_range") == F.col("_of"), *same], "left")
    return added.withColumn(name, F.col("_inside") + F.coalesce("_before", F.lit(0))).select(*df.columns, name)
