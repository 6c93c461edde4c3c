"""Batch loads into the lake and the partner export."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config
from tidemark import schema as sch
from tidemark.functions.clean import LINE, REASON, accepted, checked, clean_relational, coerce, enrich, rejected, stamp, stringify_temporals
from tidemark.plans.incremental import Marks, Window, window_name
from tidemark.session import cut
from tidemark.sinks import export as out
from tidemark.sinks import tables as sink
from tidemark.sources import files
from tidemark.sources.ledger import FileLedger
from tidemark.sources.tables import filtered, jdbc_read


def load_changes(
    spark: SparkSession, folder: str, prefix: str, keys: Sequence[str], record: T.StructType, target: T.StructType, path: str, rejects: str | None = None,
    ledger: FileLedger | None = None,
) -> bool:
    """Encrypted change files to a lake table; False where no file is there.

    Bad lines, those no key opens among them, are appended to the table ``rejects``
    with their reason. Without one, a bad line stops the load before anything is
    appended. With a ``ledger`` only files that no load has taken are read, and
    rows and rejects go to the load's own folders: a load that died is repeated
    over the same files and doubles nothing.
    """
    if ledger:
        return _load_once(ledger, folder, prefix, "", lambda paths: _checked_changes(spark, paths, keys, record, target, bool(rejects)), target, path, rejects)
    if not files.has_file(spark, folder, prefix):
        return False
    lines = files.decrypt_lines(files.read_lines(spark, folder, f"{prefix}*"), keys, "null" if rejects else "raise")
    rows = checked(lines, record, sch.without(target, "ingested_at"))
    if rejects:
        rows = cut(rows, "checked")
        rejected(rows).write.mode("append").parquet(rejects)
    sink.append(stamp(accepted(rows, strict=not rejects)), path, target)
    return True


def _checked_changes(spark: SparkSession, paths: Sequence[str], keys: Sequence[str], record: T.StructType, target: T.StructType, lenient: bool) -> DataFrame:
    lines = files.decrypt_lines(files.read_lines(spark, paths), keys, "null" if lenient else "raise")
    return checked(lines, record, sch.without(target, "ingested_at"))


def _load_once(
    ledger: FileLedger, folder: str, prefix: str, suffix: str, rows_of: Callable[[list[str]], DataFrame], target: T.StructType, path: str, rejects: str | None
) -> bool:
    """Take the files the ledger hands out, write good and bad rows to the load's folders, then name the load as done."""
    load = ledger.begin(folder, prefix, suffix)
    if load is None:
        return False
    rows = rows_of(load.paths)
    if rejects:
        rows = cut(rows, "checked")
        rejected(rows).write.mode("overwrite").parquet(load.folder(rejects))
    sink.write_checked(stamp(accepted(rows, strict=not rejects)), load.folder(path), target, mode="overwrite")
    ledger.commit(load)
    return True


def load_routed(
    spark: SparkSession, folder: str, stream: str, keys: Sequence[str], records: Mapping[str, T.StructType], targets: Mapping[str, T.StructType],
    lake: str, rejects: str | None = None,
) -> list[str]:
    """Every change file of a stream to the lake table its name is routed to; the tables that got rows."""
    names = [t for p, t in config.routes(stream).items() if t in targets and load_changes(spark, folder, p, keys, records[t], targets[t], f"{lake}/{t}", rejects)]
    return sorted(names)


def _checked_predictions(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    schema = files.PREDICTION_SCHEMA
    rows = files.read_delimited(spark, paths, schema, schema.fields[0].name)
    kept = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    typed = coerce(rows.withColumn(LINE, F.to_json(F.struct(*rows.columns))), kept, rejects="_failed")
    bad = F.when(F.size("_failed") > 0, F.concat(F.lit("not of its type: "), F.array_join("_failed", ",")))
    return typed.withColumn(REASON, bad).drop("_failed")


def load_predictions(
    spark: SparkSession, folder: str, path: str, extension: str = ".csv", rejects: str | None = None, ledger: FileLedger | None = None
) -> bool:
    """Partner CSV files to the lake's prediction table.

    Values that are not of their type become NULL; with ``rejects`` such rows go
    to that table instead, as JSON with the columns named. With a ``ledger``, as
    ``load_changes``; it needs ``rejects``.
    """
    schema = files.PREDICTION_SCHEMA
    full = sch.with_required(schema, T.StructField("ingested_at", T.TimestampType()))
    if ledger:
        if not rejects:
            raise ValueError("a load by ledger needs a table for rejects")
        return _load_once(ledger, folder, "", extension, lambda paths: _checked_predictions(spark, paths), full, path, rejects)
    if not files.has_file(spark, folder):
        return False
    rows = files.read_delimited(spark, f"{folder}/*{extension}", schema, schema.fields[0].name)
    if rejects:
        typed = cut(_checked_predictions(spark, f"{folder}/*{extension}"), "checked")
        rejected(typed).write.mode("append").parquet(rejects)
        sink.append(stamp(accepted(typed)), path, full)
    else:
        sink.append(stamp(coerce(rows, schema)), path, full)
    return True


def load_relational(spark: SparkSession, url: str, table: str, path: str, parts: int, **options: str) -> None:
    """Initial load of a relational table: read by key ranges, cleaned, fully reloaded."""
    sink.reload(clean_relational(jdbc_read(spark, url, table, config.key_field(table), parts, **options)), path)


def load_raw_copy(raw: DataFrame, tenant: str, schema: T.StructType, path: str) -> None:
    """A tenant's raw copy as first versions of the lake table."""
    sink.reload(coerce(enrich(stringify_temporals(raw), tenant), schema), path, schema)


def export_table(
    marks: Marks, job: str, table: str, df: DataFrame, folder: str, tree_user_ids: Sequence[int] | None = None, created_after=None,
    tables: Mapping[str, str] = config.EXPORT_TABLES,
) -> Window:
    """One table's window to NDJSON; the mark moves after the files are written."""
    return export_tables(marks, job, {table: df}, folder, tree_user_ids, created_after, tables)[table]


def export_tables(
    marks: Marks, job: str, frames: Mapping[str, DataFrame], folder: str, tree_user_ids: Sequence[int] | None = None, created_after=None,
    tables: Mapping[str, str] = config.EXPORT_TABLES,
) -> dict[str, Window]:
    """The next window of several tables to NDJSON, each window in a folder of its own; a later one, though it holds
    the boundary rows again, leaves earlier files alone. The marks move after all files are written."""
    windows = marks.planned_windows(job, frames)
    for table, window in windows.items():
        if window.has_data:
            rows = filtered(frames[table], (window.first, window.last), tree_user_ids, created_after, tables=tables, table=table)
            out.export(rows, f"{folder}/{table}", window_name(window), name=table)
    marks.set_all(job, windows)
    return windows
