import pytest

from tidemark.operators import changes, versions
from tidemark.operators.nesting import Child, nest_children, nest_many

VERSION = "client string, id long, event_id string, ingested_at timestamp_ntz, name string"


@pytest.fixture()
def people(frame):
    return frame(
        VERSION,
        ("north", 1, "z/2020/01", "2020-01-01", "Ann"),
        ("north", 1, "z/2020/02", "2020-02-01", "Anna"),
        ("north", 2, "z/2020/01", "2020-01-01", "Bo"),
        ("north", 2, "z/2020/01", "2020-03-01", "Bo replayed"),
        ("north", 3, "z/2020/05", "2020-01-01", "Cy"),
        ("north", 3, "z/2020/04", "2020-06-01", "Cy late"),
        ("south", 1, "z/2020/01", "2020-01-01", "Di"),
    )


def names(df):
    return sorted((r["client"], r["id"], r["name"]) for r in df.collect())


def test_newest_event_wins_then_newest_ingest_and_late_events_lose(people):
    assert names(versions.latest_by(people, ["client", "id"])) == [
        ("north", 1, "Anna"), ("north", 2, "Bo replayed"), ("north", 3, "Cy"), ("south", 1, "Di"),
    ]


def test_earliest_event(people):
    got = names(versions.latest_by(people, ["client", "id"], versions.earliest_event()))
    assert got == [("north", 1, "Ann"), ("north", 2, "Bo replayed"), ("north", 3, "Cy late"), ("south", 1, "Di")]


def test_window_bounds(people):
    closed = versions.in_window(people, "2020-01-01", "2020-02-01")
    half_open = versions.in_window(people, "2020-01-01", "2020-02-01", lower_inclusive=False)
    assert closed.count() == 5
    assert names(half_open) == [("north", 1, "Anna")]


def test_window_prunes_day_partitions(spark, people, tmp_path):
    from pyspark.sql import functions as F

    people.withColumn("ingest_date", F.to_date("ingested_at")).write.partitionBy("ingest_date").parquet(str(tmp_path / "lake"))
    window = versions.in_window(spark.read.parquet(str(tmp_path / "lake")), "2020-02-01", "2020-03-01 12:00:00")
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert window.count() == 2 and "PartitionFilters: [isnotnull(ingest_date" in plan


def test_window_finds_ids_but_history_is_ranked(people):
    ids = versions.changed_ids([(people, "id")], "id", "2020-06-01", "2020-06-01")
    assert names(versions.current_state(people, ids, "id", "id")) == [("north", 3, "Cy")]


def test_child_changes_name_their_parent(frame, people):
    mails = frame("client string, id long, contact_id long, ingested_at timestamp_ntz", ("south", 9, 1, "2021-01-01"), ("south", 8, None, "2021-01-01"))
    ids = versions.changed_ids([(people, "id"), (mails, "contact_id")], "contact_id", "2020-12-01", "2021-12-31")
    assert [tuple(r) for r in ids.collect()] == [("south", 1)]


def test_map_side_limit_in_plan(people):
    plan = versions.latest_by(people.repartition(4), ["client", "id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_upsert_replaces_and_adds(people):
    target = versions.latest_by(people.filter("ingested_at < '2020-02-01'"), ["client", "id"])
    batch = people.filter("ingested_at >= '2020-02-01'")
    merged = changes.upsert(target, batch, ["client", "id"], versions.newest_first())
    assert names(merged) == [("north", 1, "Anna"), ("north", 2, "Bo replayed"), ("north", 3, "Cy late"), ("south", 1, "Di")]


def test_update_from_refuses_double_matches(frame):
    target = frame("k long, v string", (1, "a"), (2, "b"))
    once = frame("k long, v string", (1, "x"))
    twice = frame("k long, v string", (1, "x"), (1, "y"))
    from pyspark.sql import functions as F

    new = {"v": F.col("src_v")}
    assert sorted(map(tuple, changes.update_from(target, once, {"k": "k"}, ["v"], new).collect())) == [(1, "x"), (2, "b")]
    with pytest.raises(Exception, match="more than once"):
        changes.update_from(target, twice, {"k": "k"}, ["v"], new).collect()


def test_crowded_parents_are_split_and_whole(frame):
    rows = [(1, i) for i in range(95)] + [(2, i) for i in range(3)]
    nested = nest_children(frame("p long, c long", *rows), ["p"], ["c"], "cs", limit=10, ids=["c"]).collect()
    big = [r for r in nested if r["p"] == 1]
    assert sorted(c["c"] for r in big for c in r["cs"]) == list(range(95))
    assert {r["parts"] for r in big} == {10} and len(big) > 5
    assert [(r["part"], r["parts"], [c["c"] for c in r["cs"]]) for r in nested if r["p"] == 2] == [(0, 1, [0, 1, 2])]


def test_child_tables_share_one_grouping(frame):
    a = frame("p long, x long", *[(1, i) for i in range(25)], (2, 7))
    b = frame("p long, y string", (1, "u"), (3, "w"))
    rows = nest_many({"xs": Child(a, ["x"], ["x"]), "ys": Child(b, ["y"], ["y"])}, ["p"], limit=10).collect()
    assert {(r["p"], r["n_xs"], r["n_ys"]) for r in rows} == {(1, 25, 1), (2, 1, 0), (3, 0, 1)}
    assert sum(len(r["xs"]) for r in rows if r["p"] == 1) == 25
    assert sum(len(r["ys"]) for r in rows if r["p"] == 1) == 1
