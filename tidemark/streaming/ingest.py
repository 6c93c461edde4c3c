"""Change files picked up by Structured Streaming; every run takes what is new and stops."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as sch
from tidemark.functions.clean import accepted, checked, coerce, rejected, stamp
from tidemark.operators.versions import latest_by, newest_first
from tidemark.sinks.keyed import KeyedTable
from tidemark.sources.files import decrypt_lines, with_file_order


def line_stream(
    spark: SparkSession, folder: str, prefix: str = "", archive: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Lines of new files named ``prefix*``.

    With ``archive`` consumed files are moved there; Spark moves a file while a
    later batch runs.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", f"{prefix}*")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return with_file_order(reader.load(folder))


def change_records(lines: DataFrame, keys: Sequence[str], record: T.StructType, target: T.StructType) -> DataFrame:
    """Encrypted lines to rows of the lake table: decrypt, parse, coerce, stamp.

    The processing time replaces the producer's own ingest time. ``record`` is the
    record's schema as text fields. Lines no key opens stop the stream, and so do
    bad ones; ``checked_records`` with ``run_with_rejects`` sets those apart.
    """
    return sch.align(stamp(accepted(checked_records(lines, keys, record, target), strict=True)), target)


def checked_records(lines: DataFrame, keys: Sequence[str], record: T.StructType, target: T.StructType) -> DataFrame:
    """Encrypted lines to rows of the lake table that carry their line and, if bad, the reason."""
    return checked(decrypt_lines(lines, keys, "null"), record, sch.without(target, "ingested_at"))


def run_with_rejects(rows: DataFrame, target: str, rejects: str, checkpoint: str) -> None:
    """Good and bad rows of each batch to the batch's own folder of either table; a repeat overwrites it."""

    def save(batch: DataFrame, number: int) -> None:
        batch.persist()
        stamp(accepted(batch)).write.mode("overwrite").parquet(f"{target}/batch={number}")
        rejected(batch).write.mode("overwrite").parquet(f"{rejects}/batch={number}")
        batch.unpersist()

    rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save).trigger(availableNow=True).start().awaitTermination()


def prediction_records(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Partner CSV lines to typed, stamped rows; header and blank lines dropped, lines without an id kept."""
    first = schema.fields[0].name
    text = ", ".join(f"{f.name} STRING" for f in schema.fields)
    parsed = lines.filter("value <> ''").select(F.from_csv("value", text).alias("r")).select("r.*")
    return stamp(coerce(parsed.filter(F.coalesce(F.col(first), F.lit("")) != first), schema))


def run_available(rows: DataFrame, target: str, checkpoint: str, partition: str | None = None) -> None:
    """Append what is new to a parquet table, each file exactly once, then stop."""
    writer = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    if partition:
        writer = writer.partitionBy(partition)
    writer.trigger(availableNow=True).start().awaitTermination()


def latest_stream(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("event_id", "ingested_at")) -> DataFrame:
    """Latest version per key kept as streaming state.

    The state holds one row per key; a replay of the same event with a newer
    ingest time wins, an older event that comes late does not.
    """
    rest = [c for c in changes.columns if c not in keys]
    latest = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_v"))
    return latest.select(*keys, "_v.*")


def run_upserts(latest: DataFrame, target: str, checkpoint: str) -> None:
    """Write the keys each batch changed to the batch's own folder (repeats overwrite it)."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    _start(latest, save, checkpoint)


def run_keyed(changes: DataFrame, table: KeyedTable, checkpoint: str, fold_after: int = 16) -> None:
    """Take each batch of changes into a keyed table; after ``fold_after`` batches the open ones are folded in.

    The batch's number is its token, so a batch that Spark repeats after a crash
    is taken once. No state is held by the stream, and the folders of the table
    stay bounded.
    """

    def save(batch: DataFrame, number: int) -> None:
        if len(table.append(batch, number).changes) >= fold_after:
            table.fold()
            table.vacuum()

    (
        changes.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .foreachBatch(save).trigger(availableNow=True).start().awaitTermination()
    )


def _start(rows: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    (
        rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        .foreachBatch(save).trigger(availableNow=True).start().awaitTermination()
    )


def current(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """State after all batches: the newest row written per key."""
    return latest_by(spark.read.parquet(target), keys, [F.col("batch").desc(), *newest_first()]).drop("batch")
