"""Ingest, cleaning, export and streaming round trips over the given tables.

Where a query needs files it writes them from a given table into the shared
working folder first, so its work grows with that table.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config
from tidemark import schema as sch
from tidemark.adapters import Star
from tidemark.catalog.base import query
from tidemark.functions import clean, codec
from tidemark.operators import versions
from tidemark.plans import incremental, load
from tidemark.session import work_dir
from tidemark.sinks import export, tables
from tidemark.sources import files
from tidemark.streaming import ingest

# Keys of the round trips; nothing real is protected by them.
OLD_KEY = base64.b64encode(b"0123456789abcdef").decode()
NEW_KEY = base64.b64encode(b"fedcba9876543210fedcba9876543210").decode()

DOCUMENT_TEXTS = T.StructType([T.StructField(c, T.StringType()) for c in ("client", "event_id", "doc_id", "text", "lang", "read_at")])
DOCUMENT_LAKE = sch.lake_schema(
    T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("read_at", T.TimestampNTZType()),
        ]
    )
)


def _document_lines(s: Star) -> DataFrame:
    """Documents as change records in the encrypted line format."""
    record = F.to_json(
        F.struct(
            F.lit("europe").alias("client"), F.concat(F.lit("z/"), F.lpad(F.col("doc_id").cast("string"), 13, "0")).alias("event_id"),
            "doc_id", "text", "lang", F.lit("2019-01-26T17:34:26.000Z").alias("read_at"),
        )
    )
    return s.documents().select(codec.encrypt_line(record, NEW_KEY).alias("value"))


def _document_profile(rows: DataFrame) -> DataFrame:
    return rows.select("client", "event_id", "doc_id", "lang", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("chars"), "read_at")


@query("encrypt_decrypt_roundtrip")
def _(s: Star) -> DataFrame:
    folder = work_dir(s.spark, "lines")
    _document_lines(s).write.text(folder)
    lines = files.decrypt_lines(files.read_lines(s.spark, folder), [OLD_KEY, NEW_KEY])
    rows = clean.coerce(clean.parse_json(lines.select("value"), DOCUMENT_TEXTS).drop("_corrupt"), sch.without(DOCUMENT_LAKE, "ingested_at"))
    return _document_profile(rows)


@query("file_stream_ingest")
def _(s: Star) -> DataFrame:
    base = work_dir(s.spark, "stream")
    # as many files as the scan has parts, so that a file stays a task's worth; taken in two batches
    count = max(4, s.table("documents").rdd.getNumPartitions())
    _document_lines(s).repartition(count).write.text(f"{base}/in")
    lines = ingest.line_stream(s.spark, f"{base}/in", "part", files_per_batch=-(-count // 2))
    rows = ingest.change_records(lines, [OLD_KEY, NEW_KEY], DOCUMENT_TEXTS, DOCUMENT_LAKE)
    ingest.run_available(rows, f"{base}/lake", f"{base}/checkpoint")
    return _document_profile(s.spark.read.parquet(f"{base}/lake"))


@query("ingest_rejects")
def _(s: Star) -> DataFrame:
    """Good and bad lines of a stream of change records, some broken on purpose, counted by reason."""
    base = work_dir(s.spark, "rejects")
    record = F.to_json(F.struct(
        F.expr("CASE WHEN doc_id % 17 > 0 THEN 'europe' END").alias("client"), F.concat(F.lit("z/"), F.col("doc_id").cast("string")).alias("event_id"),
        F.expr("concat(CASE WHEN doc_id % 13 = 0 THEN 'x' ELSE '' END, doc_id)").alias("doc_id"), F.length("text").cast("string").alias("text"),
        F.expr("CASE doc_id % 3 WHEN 0 THEN '0000-00-00 00:00:00' WHEN 1 THEN '2019-01-26T17:34:26.000Z' END").alias("read_at"),
    ))
    line = F.when(F.col("doc_id") % 11 == 0, F.substring(record, 1, 20)).otherwise(record)
    s.documents().select(codec.encrypt_line(line, NEW_KEY).alias("value")).write.text(f"{base}/in")
    rows = ingest.checked_records(ingest.line_stream(s.spark, f"{base}/in"), [OLD_KEY, NEW_KEY], DOCUMENT_TEXTS, DOCUMENT_LAKE)
    ingest.run_with_rejects(rows, f"{base}/lake", f"{base}/bad", f"{base}/checkpoint")
    good = s.spark.read.parquet(f"{base}/lake").select(F.lit("good").alias("reason"), F.col("doc_id").isNotNull().alias("has_id"))
    bad = s.spark.read.parquet(f"{base}/bad").select(F.col("_reason").alias("reason"), F.lit(False).alias("has_id"))
    return good.unionByName(bad).groupBy("reason").agg(F.count("*").alias("n"), F.count_if("has_id").alias("with_id"))


@query("append_and_reload")
def _(s: Star) -> DataFrame:
    """A table created from a declared schema, appended to twice, read with an added column, then reloaded."""
    path = f"{work_dir(s.spark, 'tables')}/orders"
    declared = sch.from_json('{"fields": [{"name": "o_orderkey", "type": "INT64", "mode": "REQUIRED"}, {"name": "o_orderdate", "type": "DATETIME"}, {"name": "client_partition_id", "type": "INT64"}]}')
    rows = s.table("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), (F.col("o_custkey") % 4).alias("client_partition_id"))
    tables.create_table(s.spark, path, declared, "client_partition_id")
    for part in (0, 1):
        tables.append(rows.filter(F.col("o_orderkey") % 2 == part), path, declared, "client_partition_id")
    added = tables.add_columns(s.spark, path, sch.relax(declared, "o_orderkey"), T.StructField("note", T.StringType()))
    appended = added.groupBy("client_partition_id").agg(F.count("*").alias("n"), F.count("note").alias("notes"), F.sum("o_orderkey").alias("keys")).withColumn("step", F.lit("append"))
    again = f"{path}-again"
    tables.recreate(s.spark, rows, again, declared.json())
    tables.reload(rows.filter("client_partition_id = 3"), again, declared)
    reloaded = s.spark.read.parquet(again).groupBy("client_partition_id").agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("notes"), F.sum("o_orderkey").alias("keys"))
    return appended.unionByName(reloaded.withColumn("step", F.lit("reload")))


@query("tapped_rows")
def _(s: Star) -> DataFrame:
    """Metrics observed while rows are written, next to what the written table holds."""
    path = f"{work_dir(s.spark, 'tapped')}/orders"
    rows, seen = clean.tap(s.table("orders").select("o_orderkey", "o_custkey"), "orders", keys=F.sum("o_orderkey"), least=F.min("o_custkey"))
    rows.write.parquet(path)
    found = seen.get
    written = s.spark.read.parquet(path).agg(F.count("*").alias("written"))
    return written.select(*(F.lit(found[n]).cast("long").alias(n) for n in ("rows", "keys", "least")), "written")


@query("archived_files")
def _(s: Star) -> DataFrame:
    """Two runs over a folder that gets new files; a later run archives what an earlier one has read."""
    base = work_dir(s.spark, "archive")
    for part in (0, 1, 2):
        lines = s.table("documents").filter(F.col("doc_id") % 3 == part).select(F.concat_ws(",", "doc_id", "n_chars").alias("value"))
        lines.write.mode("append").text(f"{base}/in")
        stream = ingest.line_stream(s.spark, f"{base}/in", "part", archive=f"{base}/done").select("value")
        ingest.run_available(stream, f"{base}/lake", f"{base}/checkpoint")
    lake = s.spark.read.parquet(f"{base}/lake").select(F.split("value", ",").alias("v"))
    done = s.spark.read.option("recursiveFileLookup", "true").text(f"{base}/done")
    return lake.agg(F.count("*").alias("rows_read"), F.sum(F.col("v")[1].cast("long")).alias("chars"), F.lit(not done.isEmpty()).alias("archived"))


@query("window_retry")
def _(s: Star) -> DataFrame:
    """Three runs over lake orders: one dies before its commit, newer rows arrive, the retry and the next run follow."""
    base = work_dir(s.spark, "windows")
    rows = s.lake_orders().select("client", "id", "event_id", "ingested_at").filter(F.col("ingested_at").isNotNull())
    old = rows.filter(F.col("ingested_at") < F.lit("1996-01-01").cast("timestamp_ntz"))

    class Dying(incremental.Marks):
        def set(self, *args) -> None:
            raise RuntimeError("the run is lost before its commit")

    def build(source: DataFrame):
        return lambda first, last: versions.in_window(source, first, last)

    try:
        incremental.run_window(Dying(s.spark, f"{base}/marks"), "job", "orders", {"orders": old}, build(old), f"{base}/out")
    except RuntimeError:
        pass
    marks = incremental.Marks(s.spark, f"{base}/marks")
    for _ in range(2):
        incremental.run_window(marks, "job", "orders", {"orders": rows}, build(rows), f"{base}/out")
    out = s.spark.read.parquet(f"{base}/out")
    return out.select("window", "client", "id", "event_id", "ingested_at").groupBy("client", "window").agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.max("ingested_at").alias("last")
    ).drop("window")


@query("compress_roundtrip")
def _(s: Star) -> DataFrame:
    packed = clean.clean_relational(s.documents().select("doc_id", "text"))
    restored = codec.inflate_text(F.col("text"))
    longer = s.table("documents").select("doc_id", F.length("text").alias("n"))
    return packed.select("doc_id", F.md5(restored).alias("text_md5"), (F.length("text")).alias("packed")).join(longer, "doc_id").select(
        "doc_id", "text_md5", (F.col("packed") < F.col("n")).alias("smaller")
    )


@query("csv_ingest")
def _(s: Star) -> DataFrame:
    """Predictions written as CSV with headers; every 13th number is not one."""
    folder = work_dir(s.spark, "csv")
    s.table("customer").selectExpr(
        "concat('e', c_custkey) AS entity_id", "CASE WHEN c_custkey % 13 = 0 THEN 'x1' ELSE CAST(c_custkey AS STRING) END AS tree_user_id",
        "lower(c_mktsegment) AS prediction", "'p-1' AS owner", "'trial' AS experiment_name",
        "concat('2020-01-', lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0'), ' 10:00:00') AS processing_datetime",
    ).repartition(3).write.option("header", "true").csv(folder)
    rows = files.read_delimited(s.spark, folder, files.PREDICTION_SCHEMA, "entity_id")
    return clean.coerce(rows, files.PREDICTION_SCHEMA, rejects="rejects").withColumn("rejects", F.array_join("rejects", ","))


@query("json_export")
def _(s: Star) -> DataFrame:
    rows = s.users().join(s.table("customer").selectExpr("c_custkey AS tree_user_id", "c_acctbal", "c_acctbal > 0 AS in_credit"), "tree_user_id").select(
        "tree_user_id", "sponsor_id", "client", F.to_date("created").alias("signup"), "created",
        F.when(F.col("tree_user_id") % 3 > 0, F.col("in_credit")).alias("in_credit"), F.when(F.col("tree_user_id") % 4 > 0, F.col("c_acctbal")).alias("balance"),
    )
    return export.export_rows(rows)


@query("export_files")
def _(s: Star) -> DataFrame:
    """Gzip NDJSON files written and read back."""
    folder = work_dir(s.spark, "export")
    path = export.export(s.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), folder, "staging.orders")
    return s.spark.read.schema("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string").json(path)


@query("zero_date_scrub")
def _(s: Star) -> DataFrame:
    day = "CASE WHEN o_orderkey % 5 = 0 THEN '0000-00-00 00:00:00' WHEN o_orderkey % 7 = 0 THEN '0000-00-00' ELSE CAST(o_orderdate AS STRING) END"
    rows = s.table("orders").selectExpr(
        "o_orderkey", f"{day} AS at_top", "o_orderdate AS moment", "CAST(o_orderdate AS DATE) AS day",
        f"array(named_struct('at', {day}, 'moment', o_orderdate, 'deep', array(named_struct('at', {day}, 'n', o_custkey)))) AS nested",
    )
    clean_rows = clean.stringify_temporals(rows)
    inner = F.col("nested")[0]
    return clean_rows.select(
        "o_orderkey", "at_top", "moment", "day", inner["at"].alias("at_1"), inner["moment"].alias("moment_1"),
        inner["deep"][0]["at"].alias("at_2"), inner["deep"][0]["n"].alias("n"),
    )


@query("temporal_coercion")
def _(s: Star) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'14:mm:ss.000'+05:30'")
    odd = F.when(F.col("o_orderkey") % 10 == 0, "not a date").otherwise(text)
    raw = s.table("orders").select("o_orderkey", odd.alias("wall"), odd.alias("day"), odd.alias("instant"), F.array(F.struct(odd.alias("at"))).alias("list"))
    target = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("wall", T.TimestampNTZType()),
            T.StructField("day", T.DateType()),
            T.StructField("instant", T.TimestampType()),
            T.StructField("list", T.ArrayType(T.StructType([T.StructField("at", T.TimestampNTZType())]))),
            T.StructField("added", T.StringType()),
        ]
    )
    rows = clean.coerce(raw, target, rejects="rejects")
    return rows.withColumns({"list": F.col("list")[0]["at"], "rejects": F.array_join("rejects", ",")})


@query("replay_upsert")
def _(s: Star) -> DataFrame:
    """E-mail changes arriving in files: latest version per (tenant, contact, e-mail)."""
    base = work_dir(s.spark, "replay")
    rows = s.lake_contact_emails().select("client", "contact_id", "email", "event_id", "ingested_at", "undeliverable_count")
    rows.repartition(4).write.parquet(f"{base}/in")
    stream = s.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/in")
    keys = ["client", "contact_id", "email"]
    ingest.run_upserts(ingest.latest_stream(stream, keys), f"{base}/state", f"{base}/checkpoint")
    return ingest.current(s.spark, f"{base}/state", keys)


@query("bounded_batches")
def _(s: Star) -> DataFrame:
    """Rows kept, batches over a bound, and neighbours that one batch could hold, when documents are cut into bounded batches."""
    sized = s.table("documents").select("doc_id", F.length("text").alias("chars"))
    per_batch = tables.bounded_batches(sized, "chars", max_rows=50, max_chars=100_000).groupBy("partition", "batch").agg(
        F.count("*").alias("n"), F.sum("chars").alias("chars")
    )
    over = (F.col("n") > 50) | ((F.col("chars") > 100_000) & (F.col("n") > 1))
    after = W.partitionBy("partition").orderBy("batch")
    joined = per_batch.withColumns({"n_2": F.lead("n").over(after), "chars_2": F.lead("chars").over(after)})
    half_empty = (F.col("n") + F.col("n_2") <= 50) & (F.col("chars") + F.col("chars_2") <= 100_000)
    return joined.agg(
        F.sum("n").alias("rows_kept"), F.sum("chars").alias("chars_kept"), F.count_if(over).alias("over_bound"), F.count_if(half_empty).alias("mergeable")
    )
