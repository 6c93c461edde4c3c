import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config, schema
from tidemark.plans import load
from tidemark.plans.incremental import START, Marks, Window, run_window, upper_bound
from tidemark.sinks import export, tables
from tidemark.sinks.shards import write_shards
from tidemark.sources import files
from tidemark.sources import tables as source


def put(folder, name, text=""):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_files_by_prefix_in_sequence(spark, tmp_path):
    for name in ("in-users-a-12", "in-users-b-3", "in-orders-c-1"):
        put(tmp_path, name, "x")
    put(tmp_path / "processed", "in-users-z-1", "x")
    listed = files.list_files(spark, str(tmp_path), "in-users")
    assert [(r["file_name"], r["file_seq"]) for r in listed.collect()] == [("in-users-b-3", 3), ("in-users-a-12", 12)]
    assert files.has_file(spark, str(tmp_path), "in-orders") and not files.has_file(spark, str(tmp_path), "in-sites")
    assert not files.has_file(spark, str(tmp_path / "nowhere"))


def test_file_sequence_of_unnumbered_names(frame):
    rows = frame("n string", ("part*7",), ("plain.csv",)).select(files.file_sequence(F.col("n")).alias("s")).collect()
    assert [r["s"] for r in rows] == [7, None]


def test_delimited_with_blank_line_and_header(spark, tmp_path):
    put(tmp_path, "p.csv", "\nentity_id,tree_user_id,prediction,owner,experiment_name,processing_datetime\na,1,0.5,o,x,2020-01-01 00:00:00\nb,2,0.7,o,x,2020-01-01 00:00:00\n")
    rows = files.read_delimited(spark, str(tmp_path), files.PREDICTION_SCHEMA, "entity_id")
    assert sorted(r["entity_id"] for r in rows.collect()) == ["a", "b"]


def test_prediction_load(spark, tmp_path):
    put(tmp_path / "in", "p.csv", "entity_id,tree_user_id,prediction,owner,experiment_name,processing_datetime\na,1,0.5,o,x,2020-01-01 00:00:00\n")
    full = schema.with_required(files.PREDICTION_SCHEMA, T.StructField("ingested_at", T.TimestampType()))
    lake = str(tmp_path / "lake")
    tables.create_table(spark, lake, full)
    assert load.load_predictions(spark, str(tmp_path / "in"), lake) and not load.load_predictions(spark, str(tmp_path / "none"), lake)
    row = spark.read.schema(full).parquet(lake).first()
    assert (row["tree_user_id"], row["client_partner_id"]) == (1, "o") and row["ingested_at"] is not None


def test_ratings_without_header(spark, tmp_path):
    put(tmp_path, "r.csv", "5,1,4\n6,1,2\n")
    assert sorted(map(tuple, files.read_ratings(spark, str(tmp_path)).collect())) == [(5, 1, 4), (6, 1, 2)]


def test_source_guards(spark):
    with pytest.raises(ValueError):
        source.read_source(spark, "default", query="SELECT 1", table="t")
    with pytest.raises(ValueError):
        source.read_source(spark, "default")
    with pytest.raises(ValueError):
        source.read_source(spark, query="SELECT 1")
    rows = source.read_source(spark, "default", query="SELECT :n + 1 AS m", args={"n": 1})
    assert rows.first()["m"] == 2


@pytest.mark.parametrize("top", [0, 1, 4, 5, 6, 9, 10, 11])
def test_key_ranges_lose_no_row(spark, top):
    df = spark.range(top + 1)
    assert sorted(r["id"] for r in source.key_range_read(df, "id", 5).collect()) == list(range(top + 1))
    assert source.key_range_read(df.limit(0), "id", 5).count() == 0


def test_optional_filters(frame):
    df = frame("tree_user_id long, created timestamp_ntz, ingested_at timestamp_ntz", (1, "2020-01-01", "2020-02-01"), (2, "2020-03-01", "2020-02-02"), (3, "2020-03-01", "2020-04-01"))
    assert source.filtered(df).count() == 3
    assert source.filtered(df, ("2020-02-01", "2020-02-02")).count() == 2
    assert source.filtered(df, tree_user_ids=[1, 3], created_after="2020-02-15").count() == 1
    assert source.filtered(df, tree_user_ids=list(range(2, 5000))).count() == 2
    with pytest.raises(ValueError):
        source.filtered(df, created_after="2020-01-01", tables={"t": "born"}, table="t")
    assert set(config.EXPORT_TABLES.values()) == {"created", "created_at"} and len(config.routes("x")) == 31 and len(config.RELATIONAL_TABLES) == 30


def test_append_needs_a_table_and_layout_columns_are_added(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    rows = frame("client_partition_id long, event_id string, ingested_at timestamp, name string", (2, "z/1", "2020-01-01", "a"), (4, "z/2", "2020-01-01", "b"))
    declared = T.StructType([T.StructField("name", T.StringType())])
    with pytest.raises(FileNotFoundError):
        tables.append(rows, path, declared)
    with pytest.raises(ValueError):
        tables.create_table(spark, path, declared, cluster=["event_id"])
    full = tables.create_table(spark, path, declared, *tables.STAGING_LAYOUT)
    assert full.names == ["name", "client_partition_id", "event_id", "ingested_at"]
    tables.append(rows, path, full, *tables.STAGING_LAYOUT)
    tables.append(rows, path, full, *tables.STAGING_LAYOUT)
    back = spark.read.schema(full).parquet(path)
    assert back.count() == 4 and sorted(glob.glob(f"{path}/client_partition_id=*"))[0].endswith("=2")
    assert "PartitionFilters: [isnotnull(client_partition_id" in back.filter("client_partition_id = 2")._jdf.queryExecution().toString()
    tables.reload(rows.limit(1), path, full)
    assert spark.read.schema(full).parquet(path).count() == 1


def test_schema_changes(spark, frame, tmp_path):
    base = schema.from_json(json.dumps({"fields": [
        {"name": "id", "type": "INTEGER", "mode": "REQUIRED"}, {"name": "m", "type": "NUMERIC"},
        {"name": "list", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "a", "type": "DATETIME"}]}]}))
    assert base["id"].dataType == T.LongType() and not base["id"].nullable and isinstance(base["list"].dataType.elementType, T.StructType)
    added = T.StructField("device", T.StringType(), False)
    assert schema.evolve(schema.evolve(base, added), added).names == ["id", "m", "list", "device"] and schema.evolve(base, added)["device"].nullable
    assert schema.relax(base, "id")["id"].nullable
    assert schema.lake_schema(base).names[-3:] == ["client", "event_id", "ingested_at"]
    assert schema.clone({"t": base})["t"] == base and schema.without(base, "m").names == ["id", "list"]
    frame("id long", (1,)).write.parquet(str(tmp_path / "old"))
    assert tables.add_columns(spark, str(tmp_path / "old"), base, added).first()["device"] is None
    assert schema.missing_required(frame("id long, m string", (1, "a"), (None, "b")), base).count() == 1


def test_bounded_batches_against_brute_force(spark):
    sizes = [3, 9, 1, 1, 1, 1, 12, 2, 2, 30, 1]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i long, n long").coalesce(1)
    got = {r["i"]: r["batch"] for r in tables.bounded_batches(df, "n", max_rows=3, max_chars=12).collect()}
    assert [got[i] for i in range(len(sizes))] == [0, 0, 1, 1, 1, 2, 3, 4, 4, 5, 6]


def test_export_replaces_the_folder(spark, frame, tmp_path):
    df = frame("a long, b boolean", (1, True), (2, None))
    for _ in range(2):
        path = export.export(df, str(tmp_path), "staging.t")
    lines = [json.loads(x) for f in glob.glob(f"{path}/*.gz") for x in gzip.open(f, "rt")]
    assert sorted(lines, key=lambda r: r["a"]) == [{"a": 1, "b": 1}, {"a": 2, "b": ""}]


@pytest.fixture()
def marks(spark, tmp_path):
    return Marks(spark, str(tmp_path / "marks"))


def source_rows(frame, *moments):
    return frame("ingested_at timestamp_ntz, id long", *[(m, i) for i, m in enumerate(moments)])


def test_marks(frame, marks):
    empty = {"t": source_rows(frame, "2020-01-01").limit(0)}
    window = marks.next_window("job", "t", empty)
    assert window == Window(START, None) and not window.has_data
    marks.set("job", "t", window)
    assert marks.current().count() == 0
    window = marks.next_window("job", "t", {"t": source_rows(frame, "2020-01-01", "2020-01-03")})
    assert window == Window(START, "2020-01-03 00:00:00")
    marks.set("job", "t", window)
    marks.set("other", "t", Window(START, "2021-01-01 00:00:00"))
    assert marks.get("job", "t") == "2020-01-03 00:00:00"
    marks.set("job", "t", Window(START, "2020-01-05 00:00:00"))
    assert marks.get("job", "t") == "2020-01-05 00:00:00" and marks.current().count() == 2


def test_upper_bound_is_the_newest_of_all_sources(frame):
    a, b = source_rows(frame, "2020-01-01", "2020-01-01", "2020-01-02"), source_rows(frame, "2020-01-03", "2019-01-01")
    assert str(upper_bound({"a": a, "b": b}, "2020-01-01").first()["last"]) == "2020-01-03 00:00:00"
    assert upper_bound({"a": a, "b": b}, "2021-01-01").first()["last"] is None


def test_retry_after_new_rows_repeats_the_planned_window(spark, frame, marks, tmp_path):
    target = str(tmp_path / "out")
    old, new = source_rows(frame, "2020-01-01", "2020-01-02"), source_rows(frame, "2020-01-01", "2020-01-02", "2020-01-03", "2020-01-04")

    class Broken(Marks):
        def set(self, *args):
            raise RuntimeError("lost")

    def build(rows):
        return lambda first, last: rows.filter(F.col("ingested_at").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))

    with pytest.raises(RuntimeError):
        run_window(Broken(spark, marks.path), "j", "t", {"t": old}, build(old), target)
    first = run_window(marks, "j", "t", {"t": new}, build(new), target)
    assert first.last == "2020-01-02 00:00:00" and spark.read.parquet(target).count() == 2
    assert run_window(marks, "j", "t", {"t": new}, build(new), target) == Window("2020-01-02 00:00:00", "2020-01-04 00:00:00")
    # only the boundary row counts again
    rows = spark.read.parquet(target)
    assert rows.count() == 5 and rows.select("id").distinct().count() == 4


def test_window_run_repeats_into_the_same_folder(spark, frame, marks, tmp_path):
    rows, target = source_rows(frame, "2020-01-01", "2020-01-02"), str(tmp_path / "out")
    seen = []

    def build(first, last):
        seen.append((first, last))
        return rows.filter(F.col("ingested_at").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))

    class Broken(Marks):
        def set(self, *args):
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run_window(Broken(spark, marks.path), "j", "t", {"t": rows}, build, target)
    assert run_window(marks, "j", "t", {"t": rows}, build, target).has_data
    assert spark.read.parquet(target).count() == 2 and seen[0] == seen[1]
    # the boundary row counts again
    assert run_window(marks, "j", "t", {"t": rows}, build, target).first == "2020-01-02 00:00:00"


def test_export_moves_the_mark(frame, marks, tmp_path):
    df = frame("ingested_at timestamp_ntz, tree_user_id long, created timestamp_ntz", ("2020-01-01", 1, "2020-01-01"), ("2020-01-02", 2, "2019-01-01"))
    load.export_table(marks, "export", "staging.orders", df, str(tmp_path), created_after="2019-06-01")
    lines = [json.loads(x) for f in glob.glob(f"{tmp_path}/staging.orders/*/*.gz") for x in gzip.open(f, "rt")]
    assert [r["tree_user_id"] for r in lines] == [1] and marks.get("export", "staging.orders") == "2020-01-02 00:00:00"


def test_raw_copy(spark, frame, tmp_path):
    raw = frame("id long, born string, at timestamp_ntz", (1, "0000-00-00", "2020-01-02 03:04:05"))
    target = schema.lake_schema(T.StructType([T.StructField("id", T.LongType()), T.StructField("born", T.DateType()), T.StructField("at", T.TimestampNTZType())]))
    load.load_raw_copy(raw, "north", target, str(tmp_path / "lake"))
    row = spark.read.parquet(str(tmp_path / "lake")).first()
    assert (row["id"], row["born"], row["client"], row["event_id"]) == (1, None, "north", "z/0") and str(row["at"]) == "2020-01-02 03:04:05"


def shards(path):
    return sorted(os.path.basename(f) for f in glob.glob(f"{path}/*"))


def test_numbered_shards(spark, tmp_path):
    folder = f"{tmp_path}/t"
    lines = spark.range(0, 1000, 1, 4).selectExpr("CASE WHEN id = 7 THEN NULL ELSE concat('line ', id) END AS value")
    write_shards(lines, folder, "t", shard_bytes=1500)
    names = shards(folder)
    assert len(names) > 4 and names == [f"t-{i:05d}-of-{len(names):05d}.ndjson.gz" for i in range(len(names))]
    back = [x.rstrip("\n") for f in names for x in gzip.open(f"{folder}/{f}", "rt")]
    assert back == ["" if i == 7 else f"line {i}" for i in range(1000)]
    # fewer shards replace more; an empty export leaves none
    write_shards(lines.coalesce(1), folder, "t")
    assert shards(folder) == ["t-00000-of-00001.ndjson.gz"]
    write_shards(lines.limit(0), folder, "t")
    assert shards(folder) == []


def test_a_failed_export_leaves_the_shards_of_the_last(spark, tmp_path):
    folder = f"{tmp_path}/t"
    write_shards(spark.sql("SELECT 'kept' AS value"), folder, "t")
    broken = spark.range(0, 100, 1, 4).selectExpr("CASE WHEN id = 99 THEN raise_error('broken') ELSE 'x' END AS value")
    with pytest.raises(Exception, match="broken"):
        write_shards(broken, folder, "t")
    assert shards(folder) == ["t-00000-of-00001.ndjson.gz"] and gzip.open(f"{folder}/t-00000-of-00001.ndjson.gz", "rt").read() == "kept\n"
    with pytest.raises(Exception, match="one column"):
        write_shards(spark.range(3), folder, "t")


def test_windows_of_several_tables(frame, marks, tmp_path):
    ddl = "ingested_at timestamp_ntz, tree_user_id long, created timestamp_ntz"
    frames = {t: frame(ddl, (f"2020-01-0{i}", i, "2020-01-01")) for i, t in enumerate(("staging.orders", "staging.users"), 1)} | {"staging.tasks": frame(ddl)}
    windows = load.export_tables(marks, "export", frames, str(tmp_path))
    assert {t: w.last for t, w in windows.items()} == {"staging.orders": "2020-01-01 00:00:00", "staging.users": "2020-01-02 00:00:00", "staging.tasks": None}
    assert len(glob.glob(f"{tmp_path}/staging.*/window=*/*.gz")) == 2
    # the boundary row is exported again, to a folder of its own
    later = {"staging.orders": frames["staging.orders"].unionByName(frame(ddl, ("2020-02-01", 9, "2020-01-01"))).coalesce(1)}
    assert load.export_tables(marks, "export", later, str(tmp_path))["staging.orders"].first == "2020-01-01 00:00:00"
    assert len(glob.glob(f"{tmp_path}/staging.orders/window=*/*.gz")) == 2


def test_a_planned_window_of_several_tables_is_taken_up_again(frame, marks):
    rows = source_rows(frame, "2020-01-01", "2020-01-02")
    first = marks.planned_windows("j", {"a": rows, "b": rows.limit(0)})
    more = rows.unionByName(source_rows(frame, "2020-03-01"))
    again = marks.planned_windows("j", {"a": more, "b": more})
    assert again["a"] == first["a"] and again["b"].last == "2020-03-01 00:00:00"
    marks.set_all("j", again)
    assert marks.get("j", "a") == "2020-01-02 00:00:00" and marks.planned_windows("j", {"a": more})["a"].last == "2020-03-01 00:00:00"
