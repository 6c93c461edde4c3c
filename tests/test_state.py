"""Keyed tables, refine jobs on kept versions, folded streams and repeated loads."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from test_refine import END, RULES, START, lake, tenants  # noqa: F401  (fixtures)
from test_streaming import BAD, GOOD, RECORD, TARGET, drop_file, record
from tidemark.operators.versions import in_window, latest_by
from tidemark.plans import load, refine, states
from tidemark.sinks.keyed import KeyedTable
from tidemark.sources.ledger import FileLedger
from tidemark.streaming import ingest

DDL = "client string, id long, event_id string, ingested_at timestamp_ntz, name string"


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def table(spark, path, kind=KeyedTable, **options):
    return kind(spark, str(path), T._parse_datatype_string(DDL), ["client", "id"], **{"buckets": 8, **options})


def rows(frame, ids, event, name="n", day="2020-01-01"):
    return frame(DDL, *(("c", i, event, day, name) for i in ids))


def names(df):
    return sorted((r["id"], r["name"]) for r in df.collect())


def test_a_merge_leaves_other_buckets_in_place(spark, frame, tmp_path):
    keyed = table(spark, tmp_path / "t")
    assert names(keyed.read()) == []
    keyed.merge(rows(frame, range(100), "z/1"))
    before = files_of(tmp_path / "t")
    keyed.merge(rows(frame, [3], "z/2", "new"))
    after = files_of(tmp_path / "t")
    assert before < after and len(after - before) == 1
    assert names(keyed.read()) == sorted([(i, "n") for i in range(100) if i != 3] + [(3, "new")])
    # only the rewritten bucket's old file and the first manifest go
    assert len(keyed.vacuum()) == 2 and len(files_of(tmp_path / "t")) == len(before)
    assert len(names(keyed.read())) == 100 and keyed.vacuum() == []


def test_the_rank_decides_and_not_the_order_of_merges(spark, frame, tmp_path):
    keyed = table(spark, tmp_path / "t")
    keyed.merge(rows(frame, [1, 2], "z/5", "five"))
    keyed.merge(rows(frame, [1], "z/3", "late and old").unionByName(rows(frame, [2], "z/5", "replayed", "2020-02-01")))
    keyed.merge(rows(frame, [1, 1, 4], "z/4").unionByName(rows(frame, [4], "z/6", "six")))
    assert names(keyed.read()) == [(1, "five"), (2, "replayed"), (4, "six")]


def test_a_run_that_dies_before_the_manifest(spark, frame, tmp_path):
    class Dying(KeyedTable):
        def _commit(self, version):
            raise RuntimeError("lost")

    keyed = table(spark, tmp_path / "t")
    keyed.merge(rows(frame, range(20), "z/1"))
    for change in (lambda t: t.merge(rows(frame, range(9), "z/2", "new")), lambda t: t.append(rows(frame, range(9), "z/2", "new"), 4)):
        with pytest.raises(RuntimeError, match="lost"):
            change(table(spark, tmp_path / "t", Dying))
        assert names(keyed.read()) == [(i, "n") for i in range(20)]
    keyed.merge(rows(frame, range(3), "z/2", "new"))
    assert names(keyed.read()) == [(i, "new" if i < 3 else "n") for i in range(20)]


def test_lookups_read_only_the_buckets_they_touch(spark, frame, tmp_path):
    keyed = table(spark, tmp_path / "t", buckets=16)
    keyed.merge(rows(frame, range(200), "z/1"))
    wanted = frame("client string, who long", ("c", 7), ("c", 999), (None, 3))
    found = keyed.rows_for(wanted, {"id": "who"})
    assert names(found) == [(7, "n")]
    assert len(found.inputFiles()) <= 3 < len(files_of(tmp_path / "t"))


def test_open_changes_tokens_and_folding(spark, frame, tmp_path):
    keyed = table(spark, tmp_path / "t")
    keyed.append(rows(frame, [1, 2], "z/1"), 0)
    keyed.append(rows(frame, [2, 3], "z/2", "two"), 1)
    assert keyed.append(rows(frame, [9], "z/9"), 1).number == 2  # the same batch again
    assert names(keyed.read()) == names(keyed.rows_for(frame("client string, id long", *(("c", i) for i in range(9))))) == [(1, "n"), (2, "two"), (3, "two")]
    assert keyed.fold().changes == () and keyed.version().token == 1
    assert names(keyed.read()) == [(1, "n"), (2, "two"), (3, "two")]
    assert keyed.fold().number == keyed.version().number
    with pytest.raises(ValueError, match="layout"):
        table(spark, tmp_path / "t", buckets=4).read()
    with pytest.raises(ValueError, match="several buckets"):
        KeyedTable(spark, str(tmp_path / "u"), keyed.schema, ["id"], ["client"])


def test_null_keys_and_empty_merges(spark, frame, tmp_path):
    keyed = table(spark, tmp_path / "t")
    keyed.merge(rows(frame, [], "z/1"))
    keyed.merge(frame(DDL, (None, None, "z/1", None, "a"), (None, None, "z/2", None, "b"), ("c", None, None, None, "x")))
    keyed.merge(rows(frame, [], "z/1"))
    assert sorted(r["name"] for r in keyed.read().collect()) == ["b", "x"]


def test_a_stream_folded_into_a_table(spark, frame, tmp_path):
    keyed = table(spark, tmp_path / "t")

    def arrive(*found):
        frame(DDL, *found).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        ingest.run_keyed(stream, keyed, str(tmp_path / "cp"), fold_after=2)
        return names(keyed.read())

    assert arrive(("n", 1, "z/2", "2020-01-01", "a"), ("n", 2, "z/1", "2020-01-01", "b")) == [(1, "a"), (2, "b")]
    assert arrive(("n", 2, "z/1", "2020-02-01", "b again"), ("n", 1, "z/1", "2020-03-01", "late")) == [(1, "a"), (2, "b again")]
    assert keyed.version().changes == ()
    assert arrive(("n", 1, "z/3", "2020-01-02", "c")) == [(1, "c"), (2, "b again")]
    for i in range(4):
        arrive(("n", 5, f"z/{i}", "2020-01-02", f"v{i}"))
    folders = sum(len(os.listdir(tmp_path / "t" / kind)) for kind in ("data", "changes") if (tmp_path / "t" / kind).exists())
    assert folders <= 6 and names(keyed.read())[-1] == (5, "v3")


def test_refine_jobs_on_states_equal_those_on_full_history(spark, lake, tenants, tmp_path):  # noqa: F811
    kept = states.StatefulLake(spark, lake, str(tmp_path / "s"), buckets=4)
    kept.advance(None, "2019-01-15")
    kept.advance("2019-01-15", END)
    shown = lambda df: sorted(map(str, df.collect()))
    for first in (START, "2019-01-20"):
        for job in (lambda x: refine.staging_users(x, tenants, RULES, first, END), lambda x: refine.staging_orders(x, tenants, RULES, first, END)):  # noqa: B023
            assert shown(job(kept)) == shown(job(lake))


def test_a_load_that_dies_is_repeated_once(spark, tmp_path):
    class Dying(FileLedger):
        def commit(self, load):
            raise RuntimeError("lost")

    folder, out, bad = str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "bad")
    run = lambda ledger: load.load_changes(spark, folder, "users-", [BAD, GOOD], RECORD, TARGET, out, bad, ledger)
    ledger = FileLedger(spark, str(tmp_path / "ledger"))
    assert not run(ledger)
    drop_file(spark, folder, "users-a-1", record(1), "no record")
    with open(f"{folder}/users-a-2", "w") as f:
        f.write("0" * 32 + ":" + "0" * 32 + "\n")
    with pytest.raises(RuntimeError):
        run(Dying(spark, str(tmp_path / "ledger")))
    assert ledger.read(out, TARGET).count() == 0  # left over, but not committed
    drop_file(spark, folder, "users-a-3", record(3))
    drop_file(spark, folder, "orders-a-1", record(9))
    assert run(ledger) and sorted(r["id"] for r in ledger.read(out, TARGET).collect()) == [1]
    assert run(ledger) and not run(ledger)
    assert sorted(r["id"] for r in ledger.read(out, TARGET).collect()) == [1, 3]
    reasons = ledger.read(bad, T.StructType([T.StructField(c, T.StringType()) for c in ("_line", "_reason")])).collect()
    assert sorted((r["_reason"], r["_line"][:4]) for r in reasons) == [("no key opens it", "0000"), ("not a record", "no r")]


def test_predictions_by_ledger(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    for i, rating in enumerate(("7", "seven")):
        (tmp_path / "in" / f"p{i}.csv").write_text(f"entity_id,tree_user_id,prediction,owner,experiment_name,processing_datetime\na{i},{rating},0.5,o,x,2020-01-01 00:00:00\n")
    ledger = FileLedger(spark, str(tmp_path / "ledger"))
    run = lambda: load.load_predictions(spark, str(tmp_path / "in"), str(tmp_path / "out"), rejects=str(tmp_path / "bad"), ledger=ledger)
    assert run() and not run()
    schema = T.StructType([T.StructField("entity_id", T.StringType())])
    assert [r[0] for r in ledger.read(str(tmp_path / "out"), schema).collect()] == ["a0"]
    assert ledger.read(str(tmp_path / "bad"), T.StructType([T.StructField("_reason", T.StringType())])).collect()[0][0] == "not of its type: tree_user_id"
    with pytest.raises(ValueError):
        load.load_predictions(spark, str(tmp_path / "in"), str(tmp_path / "out"), ledger=ledger)


def test_states_take_late_events(spark, frame, tmp_path):
    history = frame("client string, id long, event_id string, ingested_at timestamp_ntz, sponsor_id long",
                    ("c", 1, "z/2", "2020-01-01", 1), ("c", 1, "z/1", "2020-02-01", 2), ("c", 2, "z/1", "2020-02-02", 3), ("c", 2, "z/1", "2020-03-01", 4))
    kept = states.StatefulLake(spark, {"tree_users": history}, str(tmp_path / "s"), buckets=2)
    for first, last in ((None, "2020-01-15"), ("2020-01-15", "2020-02-15"), ("2020-01-15", "2020-02-15"), ("2020-02-15", "2020-04-01")):
        kept.advance(first, last)
        found = kept.known("tree_users", "id", history.select("client", F.col("id").alias("who")), "who")
        assert sorted(map(str, found.collect())) == sorted(map(str, latest_by(in_window(history, START, last), ["client", "id"]).collect()))
