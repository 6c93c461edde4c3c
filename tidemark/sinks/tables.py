"""Table sinks: append, reload, partitioned and clustered create, bounded batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as sch
from tidemark.sources.files import exists

# Layouts: (partition column, columns rows are sorted by inside a file). Fixed values.
STAGING_LAYOUT = ("client_partition_id", ["event_id", "ingested_at"])
LAKE_LAYOUT = ("ingest_date", ["client", "event_id", "ingested_at"])


def create_table(
    spark: SparkSession, path: str, schema: T.StructType | None, partition: str | None = None, cluster: Sequence[str] = ()
) -> T.StructType:
    """Create an empty table; columns the layout needs are added to the schema.

    Clustering needs a partition column and a schema.
    """
    if cluster and (partition is None or schema is None):
        raise ValueError("clustering needs a partition column and a schema")
    if schema is None:
        raise ValueError("a table needs a schema")
    required = {f.name: f for f in (sch.PARTITION_FIELD, sch.TENANT_FIELD, *sch.VERSION_FIELDS, T.StructField("ingest_date", T.DateType()))}
    full = sch.with_required(schema, *(required[c] for c in (partition, *cluster) if c in required))
    write(spark.createDataFrame([], full), path, partition, cluster, mode="errorifexists")
    return full


def write(df: DataFrame, path: str, partition: str | None = None, cluster: Sequence[str] = (), mode: str = "append") -> None:
    """Partitioned write, rows sorted by the cluster columns so row groups can be skipped.

    Rows are gathered by the partition column, so a tenant gets few files; of a
    tenant that owns a third of all rows AQE makes several tasks.
    """
    if partition:
        df = df.hint("rebalance", F.col(partition))
    if cluster:
        df = df.sortWithinPartitions(*([partition] if partition else []), *cluster)
    writer = df.write.mode(mode)
    if partition:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def append(df: DataFrame, path: str, schema: T.StructType, partition: str | None = None, cluster: Sequence[str] = ()) -> None:
    """Append to a table that must exist, in its declared columns.

    A NULL in a column the schema requires stops the write.
    """
    if not exists(df.sparkSession, path):
        raise FileNotFoundError(f"append never creates a table: {path}")
    write_checked(df, path, schema, partition, cluster)


def write_checked(df: DataFrame, path: str, schema: T.StructType, partition: str | None = None, cluster: Sequence[str] = (), mode: str = "append") -> None:
    """Write the declared columns; a NULL in a column the schema requires stops the write."""
    rows = sch.align(df, schema)
    required = [f.name for f in schema.fields if not f.nullable]
    stop = lambda c: F.raise_error(F.lit(f"required column {c} is NULL"))
    write(rows.withColumns({c: F.when(F.col(c).isNull(), stop(c)).otherwise(F.col(c)) for c in required}), path, partition, cluster, mode)


def reload(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Replace the table's rows."""
    write(df if schema is None else sch.align(df, schema), path, mode="overwrite")


def recreate(spark: SparkSession, df: DataFrame, path: str, schema_json: str) -> None:
    """Drop, create from a JSON schema, and insert."""
    reload(df, path, sch.from_json(schema_json))


def add_columns(spark: SparkSession, path: str, schema: T.StructType, *added: T.StructField) -> DataFrame:
    """Read a table whose older files lack the added columns."""
    return spark.read.schema(sch.evolve(schema, *added)).parquet(path)


# Rows and characters one batch may hold. Fixed values.
MAX_ROWS, MAX_CHARS = 10_000, 8_000_000


def bounded_batches(df: DataFrame, length: str, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Number rows into batches, within each partition, that stay under both bounds.

    A new batch starts with the row that would pass a bound; a row longer than the
    bound is a batch of its own, a NULL length counts as 0. Nothing is shuffled and
    only the length column leaves the JVM; ends of batches are looked up in running
    sums. ``(partition, batch)`` is added to each row.
    """

    @F.pandas_udf("long")
    def number(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        batch = rows = chars = 0
        for column in columns:
            sums = np.concatenate([[0], np.cumsum(column.fillna(0).to_numpy())])
            out, at, n = np.empty(len(column), np.int64), 0, len(column)
            while at < n:
                fit = int(np.searchsorted(sums, sums[at] + max_chars - chars, "right")) - 1
                end = min(n, at + max_rows - rows, fit if rows else max(fit, at + 1))
                if end <= at:
                    batch, rows, chars = batch + 1, 0, 0
                    continue
                out[at:end] = batch
                rows, chars, at = rows + end - at, chars + sums[end] - sums[at], end
            yield pd.Series(out)

    return df.withColumns({"partition": F.spark_partition_id(), "batch": number(F.col(length))})
