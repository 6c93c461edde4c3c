"""Keyed changes on immutable tables: upsert, conditional and joined updates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.versions import latest_by


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Rows of ``batch`` replace those of equal key; new keys are added.

    With ``order`` the batch may hold several rows per key, of which the first
    in that order counts.
    """
    new = latest_by(batch, keys, order) if order else batch
    return target.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*target.columns))


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """``UPDATE ... SET col = value WHERE condition``; all values see the old row."""
    flagged = df.withColumn("_hit", condition)
    new = {name: F.when(F.col("_hit"), value).otherwise(F.col(name)) for name, value in values.items()}
    return flagged.withColumns(new).drop("_hit")


def update_from(
    df: DataFrame, source: DataFrame, on: Mapping[str, str], take: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """``UPDATE df SET ... FROM source``: rows without a partner stay as they are.

    A target row may match one source row only; a key that occurs twice in the
    source raises. Source columns are seen under the prefix ``src_``.
    """
    one = source.groupBy(*(F.col(k).alias(f"_k_{own}") for own, k in on.items())).agg(
        F.first(F.struct(*take)).alias("_src"), F.count("*").alias("_copies")
    )
    checked = one.withColumn(
        "_src",
        F.when(F.col("_copies") == 1, F.col("_src")).otherwise(
            F.raise_error(F.lit("update source holds a key more than once"))
        ),
    )
    joined = df.join(checked, [F.col(own) == F.col(f"_k_{own}") for own in on], "left")
    seen = joined.withColumns({f"src_{c}": F.col(f"_src.{c}") for c in take})
    hit = F.col("_copies").isNotNull()
    new = {name: F.when(hit, value).otherwise(F.col(name)) for name, value in values.items()}
    return seen.withColumns(new).select(*df.columns)
