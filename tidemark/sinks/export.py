"""Partner export: numbered gzip NDJSON shards, one folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.clean import stringify_temporals, to_ndjson
from tidemark.sinks.shards import SHARD_BYTES, write_shards


def export_rows(df: DataFrame) -> DataFrame:
    """JSON text per row: temporals as text, NULL as ``""``, booleans as 0/1."""
    return to_ndjson(stringify_temporals(df))


def export(df: DataFrame, folder: str, table: str, shard_bytes: int = SHARD_BYTES, name: str | None = None) -> str:
    """Replace the table's folder with shards ``<table>-0000i-of-0000N.ndjson.gz`` (of another ``name`` if given)."""
    path = f"{folder}/{table}"
    write_shards(export_rows(df), path, name or table, shard_bytes)
    return path
