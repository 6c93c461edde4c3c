"""Verification profile: row count and date range per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.versions import union_all


def table_profile(tables: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """``tbl, cnt, min, max`` per table, sorted by name; tables without a date column have no range."""

    def one(name: str, df: DataFrame, moment: str | None) -> DataFrame:
        span = [F.lit(None), F.lit(None)] if moment is None else [F.min(moment), F.max(moment)]
        low, high = (c.cast("timestamp_ntz") for c in span)
        return df.agg(F.count("*").alias("cnt"), low.alias("min"), high.alias("max")).select(F.lit(name).alias("tbl"), "cnt", "min", "max")

    return union_all(one(name, df, moment) for name, (df, moment) in tables.items()).orderBy("tbl")
