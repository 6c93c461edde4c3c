"""Table and query sources, key-range reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versions import INGESTED, in_window


def read_source(spark: SparkSession, project: str | None = None, query: str | None = None, table: str | None = None, args: Mapping | None = None) -> DataFrame:
    """A whole table, or the result of a query; exactly one of both.

    ``project`` is the database a query resolves its names in, and is required for
    one. ``args`` binds the query's named parameters (``:first``).
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    if table is not None:
        return spark.table(f"{project}.{table}" if project and "." not in table else table)
    if project is None:
        raise ValueError("a query needs a project")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(project)
    try:
        return spark.sql(query, args=dict(args or {}))
    finally:
        spark.catalog.setCurrentDatabase(before)


def key_ranges(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """Adjacent closed ranges that cover every key from ``low`` to ``high``."""
    parts = max(1, min(parts, high - low + 1))
    width, extra = divmod(high - low + 1, parts)
    ranges, start = [], low
    for i in range(parts):
        end = start + width - 1 + (1 if i < extra else 0)
        ranges.append((start, end))
        start = end + 1
    return ranges


def range_predicates(key: str, low: int, high: int, parts: int) -> list[str]:
    """A condition for each range; keys that are NULL belong to the first."""
    first, *others = (f"{key} BETWEEN {a} AND {b}" for a, b in key_ranges(low, high, parts))
    return [f"({first}) OR {key} IS NULL", *others]


def balanced_predicates(keys: DataFrame, key: str, parts: int) -> list[str]:
    """Conditions for ranges of about equal counts: bounds are quantiles of the keys, found in one pass over them.

    Ranges hold their upper bound; a key that fills several quantiles alone is one range. Rows without a key belong to
    the first range. Empty where there is no key.
    """
    shares = [i / parts for i in range(1, parts)]
    found = keys.agg(F.percentile_approx(key, shares, 100 * parts).alias("bounds")).first()["bounds"] if shares else []
    if found is None:
        return []
    bounds = sorted(set(found))
    if not bounds:
        return ["TRUE"]
    between = [f"{key} > {a} AND {key} <= {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} <= {bounds[0]} OR {key} IS NULL", *between, f"{key} > {bounds[-1]}"]


def key_range_read(df: DataFrame, key: str, parts: int, balanced: bool = False) -> DataFrame:
    """The table read in key ranges, each pushed to the scan; no row is lost.

    Rows without a key are in the first range, as in ``jdbc_read``. Ranges are of equal width, or with ``balanced`` of
    equal counts, which keys with gaps need. Worth its extra scans only where a source is not split by itself; files
    are.
    """
    if balanced:
        ranges = balanced_predicates(df.select(key), key, parts)
        return reduce(DataFrame.unionByName, (df.filter(p) for p in ranges)) if ranges else df
    span = df.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    if span["high"] is None:
        return df
    return reduce(DataFrame.unionByName, (df.filter(p) for p in range_predicates(key, span["low"], span["high"], parts)))


def jdbc_read(spark: SparkSession, url: str, table: str, key: str, parts: int, fetch_size: int = 10_000, balanced: bool = False, **options: str) -> DataFrame:
    """A relational table read by several tasks, each with a key range and a server-side cursor.

    With ``balanced`` the keys alone are read first, and ranges of equal counts are made from them.
    """
    options = {"fetchsize": str(fetch_size), **options}
    span = spark.read.format("jdbc").options(url=url, query=f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}", **options).load().first()
    if span is None or span["high"] is None:
        return spark.read.format("jdbc").options(url=url, query=f"SELECT * FROM {table} WHERE 1 = 0", **options).load()
    ranges = range_predicates(key, int(span["low"]), int(span["high"]), parts)
    if balanced:
        ranges = balanced_predicates(spark.read.jdbc(url, f"(SELECT {key} FROM {table}) k", predicates=ranges, properties=options), key, parts)
    return spark.read.jdbc(url, table, predicates=ranges, properties=options)


def jdbc_to_json(spark: SparkSession, url: str, table: str, path: str, key: str, parts: int, **options: str) -> None:
    """Copy a relational table to JSON files."""
    jdbc_read(spark, url, table, key, parts, **options).write.mode("overwrite").json(path)


def filtered(
    df: DataFrame, window: tuple | None = None, tree_user_ids: Sequence[int] | DataFrame | None = None, created_after=None, created_field: str = "created",
    tables: Mapping[str, str] | None = None, table: str | None = None,
) -> DataFrame:
    """Optional conjunctive filters; without any the whole table.

    With ``tables`` the creation column is that configured for ``table``. Ids are
    matched by a semi-join, so the list may be long.
    """
    if window is not None:
        df = in_window(df, *window, column=INGESTED)
    if created_after is not None:
        column = tables[table] if tables is not None else created_field
        if column not in df.columns:
            raise ValueError(f"{table or 'the table'} has no creation column {column}")
        df = df.filter(F.col(column) >= F.lit(created_after).cast(df.schema[column].dataType))
    if tree_user_ids is not None:
        df = semi_join_ids(df, "tree_user_id", tree_user_ids)
    return df


def semi_join_ids(df: DataFrame, column: str, ids: Sequence | DataFrame) -> DataFrame:
    """Rows whose column is among ``ids``: a list, compared in the column's own type, or the one column of a table."""
    from pyspark.sql import types as T

    from tidemark.session import local_table

    if not isinstance(ids, DataFrame):
        ids = local_table(df.sparkSession, [{column: i} for i in set(ids)], T.StructType([T.StructField(column, df.schema[column].dataType)]))
    return df.join(ids.toDF(column), column, "left_semi")

