import base64
import glob
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema
from tidemark.catalog import QUERIES
from tidemark.functions import codec
from tidemark.plans import load
from tidemark.sinks import tables
from tidemark.sources import files
from tidemark.streaming import ingest

BAD, GOOD = (base64.b64encode(c * 16).decode() for c in (b"x", b"y"))
RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("client", "event_id", "ingested_at", "id", "born", "at")])
TARGET = schema.lake_schema(T.StructType([T.StructField("id", T.LongType()), T.StructField("born", T.DateType()), T.StructField("at", T.TimestampNTZType())]))


def drop_file(spark, folder, name, *records):
    lines = spark.createDataFrame([(r,) for r in records], "value string").select(codec.encrypt_line(F.col("value"), GOOD).alias("value"))
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(r["value"] for r in lines.collect()) + "\n")


def record(i):
    return f'{{"client": "north", "event_id": "z/{i}", "ingested_at": "1999-01-01", "id": {i}, "born": "0000-00-00", "at": "2019-01-26T17:34:26.000Z"}}'


def run(spark, tmp_path, archive=None):
    lines = ingest.line_stream(spark, str(tmp_path / "in"), "users-", archive)
    ingest.run_available(ingest.change_records(lines, [BAD, GOOD], RECORD, TARGET), str(tmp_path / "lake"), str(tmp_path / "cp"))
    return spark.read.parquet(str(tmp_path / "lake"))


def test_new_files_once_and_archived_by_a_later_run(spark, tmp_path):
    folder, archive = str(tmp_path / "in"), str(tmp_path / "done")
    drop_file(spark, folder, "users-a-1", record(1), record(2))
    drop_file(spark, folder, "orders-a-1", record(9))
    first = run(spark, tmp_path, archive)
    assert sorted(r["id"] for r in first.collect()) == [1, 2]
    row = first.filter("id = 1").first()
    # processing time replaces the producer's; the zero date is no date
    assert row["ingested_at"].year > 1999 and row["born"] is None and str(row["at"]) == "2019-01-26 17:34:26"
    assert run(spark, tmp_path, archive).count() == 2
    drop_file(spark, folder, "users-a-2", record(3))
    assert sorted(r["id"] for r in run(spark, tmp_path, archive).collect()) == [1, 2, 3]
    drop_file(spark, folder, "users-a-3", record(4))
    assert run(spark, tmp_path, archive).count() == 4
    assert glob.glob(f"{archive}/**/users-a-1", recursive=True) and os.path.exists(f"{folder}/orders-a-1")


def test_batch_load_of_the_same_files(spark, tmp_path):
    folder, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    tables.create_table(spark, lake, TARGET)
    assert not load.load_changes(spark, folder, "users-", [BAD, GOOD], RECORD, TARGET, lake)
    drop_file(spark, folder, "users-a-1", record(1), record(2))
    assert load.load_changes(spark, folder, "users-", [BAD, GOOD], RECORD, TARGET, lake)
    assert spark.read.schema(TARGET).parquet(lake).count() == 2


def test_prediction_lines(frame):
    lines = frame("value string", ("",), ("entity_id,tree_user_id,prediction,owner,experiment_name,processing_datetime",), ("a,7,0.5,o,x,2020-01-01 00:00:00",), ("b,seven,0.5,o,x,soon",))
    rows = ingest.prediction_records(lines, files.PREDICTION_SCHEMA).collect()
    assert [(r["entity_id"], r["tree_user_id"], r["processing_datetime"] is not None) for r in rows] == [("a", 7, True), ("b", None, False)]


def test_replays_and_late_events_over_several_runs(spark, frame, tmp_path):
    ddl = "client string, id long, event_id string, ingested_at timestamp_ntz, name string"

    def arrive(*rows):
        frame(ddl, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
        ingest.run_upserts(ingest.latest_stream(stream, ["client", "id"]), str(tmp_path / "state"), str(tmp_path / "cp"))
        return sorted((r["id"], r["name"]) for r in ingest.current(spark, str(tmp_path / "state"), ["client", "id"]).collect())

    assert arrive(("n", 1, "z/2", "2020-01-01", "a"), ("n", 2, "z/1", "2020-01-01", "b")) == [(1, "a"), (2, "b")]
    # a replay of the same event wins, an older event that comes late does not
    assert arrive(("n", 2, "z/1", "2020-02-01", "b again"), ("n", 1, "z/1", "2020-03-01", "late")) == [(1, "a"), (2, "b again")]
    assert arrive(("n", 1, "z/3", "2020-01-02", "c")) == [(1, "c"), (2, "b again")]


def test_stream_files_grow_in_number_with_the_texts(spark, tmp_path, monkeypatch):
    docs = spark.range(1200).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang")
    docs.repartition(12).write.parquet(f"{tmp_path}/tables/documents.parquet")
    monkeypatch.setattr("tidemark.catalog.ingest.work_dir", lambda spark, name: f"{tmp_path}/{name}")
    given = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "64k"}
    before = {k: spark.conf.get(k) for k in given}
    for k, v in given.items():
        spark.conf.set(k, v)
    try:
        rows = QUERIES["file_stream_ingest"](spark, f"{tmp_path}/tables").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r["doc_id"] for r in rows) == list(range(1200)) and {r["client"] for r in rows} == {"europe"}
    assert len(list(tmp_path.glob("stream/in/part-*"))) == 12
    assert len(list(tmp_path.glob("stream/checkpoint/commits/[0-9]*"))) == 2
