"""Trees from edges, range joins, running totals and balanced key ranges, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranges, windows
from tidemark.plans import lineage
from tidemark.sources import tables


def edges_of(seed, n=80):
    rng = random.Random(seed)
    return [(i, None if i < 3 else rng.choice([i - 1, rng.randrange(i), 2])) for i in range(n)]


def climb(parent, i):
    out = []
    while parent.get(i) is not None and parent[i] in parent:
        i = parent[i]
        out.append(i)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_forest(frame, seed):
    given = [*edges_of(seed), (900, 901), (901, 902), (902, 900), (903, 902), (904, 904), (905, 12345), (None, 3)]
    parent = dict(given[:80]) | {905: None}
    df = frame("member long, boss long", *given)
    forest, cyclic = lineage.split_cycles(df, "member", "boss")
    assert sorted(r[0] for r in cyclic.collect()) == [900, 901, 902, 903, 904]
    assert {r["id"]: r["up"] for r in forest.collect()} == parent
    pairs = sorted((r["id"], r["distance"], r["ancestor"]) for r in lineage.ancestors(forest).collect())
    assert pairs == sorted((i, d, a) for i in parent for d, a in enumerate(climb(parent, i), 1))
    found = lineage.nested_sets(forest)
    children = {i: sorted(c for c in parent if parent[c] == i) for i in parent}
    want, at = {}, 0

    def walk(i, depth):
        nonlocal at
        at += 1
        left = at
        for c in children[i]:
            walk(c, depth + 1)
        at += 1
        want[i] = (depth, (at - left + 1) // 2, left, at)

    for root in sorted(i for i in parent if parent[i] is None):
        walk(root, 0)
    assert {r["id"]: (r["depth"], r["size"], r["lft"], r["rgt"]) for r in found.collect()} == want
    facts = frame("id long, v long", *((i, i * 7) for i in range(0, 80, 3)), (5, 100), (5, 1), (999, 4))
    value = {i: sum(i2 * 7 for i2 in [i] if i % 3 == 0) + (101 if i == 5 else 0) for i in parent if i != 905} | {905: 0}
    sums = {r["id"]: r["total"] for r in lineage.subtree_sums(found, facts, {"total": F.col("v")}).collect()}
    assert sums == {i: sum(value[x] for x in parent if want[i][2] <= want[x][2] <= want[i][3]) for i in parent}


def test_a_deep_chain(frame, spark):
    chain = spark.range(300).selectExpr("id AS tree_user_id", "CASE WHEN id > 0 THEN id - 1 END AS sponsor_id")
    closure = lineage.upline(chain)
    assert closure.count() == 300 * 299 // 2
    assert closure.groupBy("tree_user_id").agg(F.count("*").alias("n")).filter("n <> tree_user_id").count() == 0


def test_empty_tree(frame):
    forest, cyclic = lineage.split_cycles(frame("a long, b long"), "a", "b")
    assert forest.count() == cyclic.count() == lineage.ancestors(forest).count() == lineage.nested_sets(forest).count() == 0


def test_running_total_of_a_hot_key(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id % 3 > 0 THEN 1 WHEN id % 7 = 0 THEN NULL ELSE id % 5 END AS k", "id AS o", "id % 11 AS v").repartition(5)
    out = windows.running_total(df, ["k"], ["o"], "v", "total")
    sums, bad = {}, 0
    for r in sorted(out.collect(), key=lambda r: r["o"]):
        sums[r["k"]] = sums.get(r["k"], 0) + r["v"]
        bad += r["total"] != sums[r["k"]]
    assert out.count() == 5000 and not bad
    whole = windows.running_total(df, [], ["o"], "v", "total").agg(F.max("total")).first()[0]
    assert whole == sum(i % 11 for i in range(5000))


@pytest.mark.parametrize("crowd", [100_000, 7])
def test_points_in_spans(frame, crowd):
    rng = random.Random(3)
    points = [(rng.choice(["a", "a", "b", None]), i, rng.choice([None, 5, rng.randint(-1000, 1000)])) for i in range(400)]
    spans = [(rng.choice(["a", "b", None]), i, low := rng.choice([None, rng.randint(-1000, 1000)]), None if low is None else low + rng.choice([-5, 0, 1, 40, 700])) for i in range(400)]
    got = ranges.within(frame("k string, p long, at long", *points), frame("k string, s long, low long, high long", *spans), ["k"], "at", "low", "high", crowd)
    want = sorted((p, s) for k, p, at in points for k2, s, low, high in spans if k is not None and k == k2 and None not in (at, low) and low <= at <= high)
    assert sorted((r["p"], r["s"]) for r in got.collect()) == want and len(want) > 100
    assert "NestedLoop" not in got._jdf.queryExecution().toString() and "Cartesian" not in got._jdf.queryExecution().toString()


def test_spans_of_time_and_clashing_columns(frame):
    points = frame("k long, at timestamp_ntz", (1, "2020-01-31 23:59:59"), (1, "2020-02-01"), (1, None))
    spans = frame("k long, low timestamp_ntz, high timestamp_ntz", (1, "2020-01-01", "2020-02-01"), (1, "2020-02-01", "2020-02-01"))
    assert ranges.within(points, spans, ["k"], "at", "low", "high").count() == 3
    assert ranges.within(points, spans.filter("false"), ["k"], "at", "low", "high").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        ranges.within(points, spans.withColumn("at", F.lit(1)), ["k"], "at", "low", "high")
    with pytest.raises(TypeError):
        ranges.within(points.withColumn("at", F.lit("x")), spans, ["k"], "at", "low", "high")


def test_points_on_many_levels_are_not_broadcast(spark):
    points = spark.range(300).selectExpr("id % 7 AS k", "id AS p", "id AS at")
    spans = spark.range(60).selectExpr("id % 7 AS k", "id AS low", "id + (1L << CAST(id % 20 AS INT)) AS high")
    got = ranges.within(points, spans, ["k"], "at", "low", "high")
    last = got._jdf.queryExecution().sparkPlan().toString().split("Join [", 1)[0]
    assert last.rstrip().endswith("SortMerge"), last
    assert got.count() == sum(r["low"] <= p <= r["high"] for r in spans.collect() for p in range(300) if p % 7 == r["k"])


def test_ranges_of_equal_counts(spark, frame):
    keys = spark.range(3000).selectExpr("CASE WHEN id % 10 = 0 THEN NULL WHEN id < 2500 THEN id % 40 + 1000000 ELSE id * 1000000 END AS key")
    parts = tables.balanced_predicates(keys, "key", 8)
    counts = [keys.filter(p).count() for p in parts]
    assert sum(counts) == 3000 and max(counts) <= 2 * 3000 / 8 + 300
    assert tables.key_range_read(keys, "key", 8, balanced=True).count() == 3000
    assert tables.key_range_read(frame("key long", (None,), (None,)), "key", 3, balanced=True).count() == 2
    hot = spark.range(100).selectExpr("CASE WHEN id < 90 THEN 5 ELSE id END AS key")
    assert tables.key_range_read(hot, "key", 4, balanced=True).count() == 100
    assert tables.key_range_read(hot, "key", 1, balanced=True).count() == 100
