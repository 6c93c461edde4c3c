"""Registry of queries: each reads the given tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import session
from tidemark.adapters import Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the registered reports: cohort, evaluation day, refine window.
LOW, HIGH = "1995-03-01", "1996-06-30"
AS_OF = "2001-06-30"
FIRST, LAST = "1996-01-01", "1996-12-31"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, temporals as text: values any client compares alike."""

    def shown(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return value.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return value.cast("string").alias(field.name)
        return value

    return df.select(*(shown(f) for f in df.schema.fields))


def query(name: str):
    """Register ``fn(star)`` under a name."""

    def register(fn: Callable[[Star], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Star(session.tune(spark), folder)))

        QUERIES[name] = run
        return fn

    return register
