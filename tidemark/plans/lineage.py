"""Trees given as edges ``(id, parent)``: cycles, all ancestors, depths, subtree sums and nested-set intervals.

All of them go by pointer doubling: after ``k`` rounds a node knows its ancestor ``2 ** k`` above, so a chain of a
million takes twenty joins of two keyed sets. Each round is written once and reads the one before.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import running_total
from tidemark.session import cut


def _edges(df: DataFrame, node: str, parent: str) -> DataFrame:
    """``(id, up)``, one row per node; parents that are no node themselves are none."""
    rows = df.filter(F.col(node).isNotNull()).groupBy(F.col(node).alias("id")).agg(F.min(parent).alias("up"))
    rows = cut(rows, "edges")
    known = rows.select(F.col("id").alias("up"), F.lit(True).alias("_known"))
    # most nodes share few parents, so look up each parent once
    real = rows.filter(F.col("up").isNotNull()).select("up").distinct().join(known, "up")
    return rows.join(real, "up", "left").select("id", F.when(F.col("_known"), F.col("up")).alias("up"))


def split_cycles(df: DataFrame, node: str, parent: str) -> tuple[DataFrame, DataFrame]:
    """``(forest, cyclic)``: edges ``(id, up)`` of the nodes whose ancestors end, and the ids of those whose do not.

    Of several parents of a node the smallest counts. In each round nodes whose ancestors end drop out while there are
    any, so a round without a loss leaves nodes on, or below, a cycle only.
    """
    edges = cut(_edges(df, node, parent), "edges")
    jump, left = edges.filter("up IS NOT NULL"), None
    while True:
        count = jump.count()
        if not count or count == left:
            break
        left = count
        above = jump.select(F.col("id").alias("up"), F.col("up").alias("next"))
        jump = cut(jump.join(above, "up").select("id", F.col("next").alias("up")), "jump")
    cyclic = jump.select("id")
    return cut(edges.join(cyclic, "id", "left_anti"), "forest"), cyclic


def ancestors(forest: DataFrame) -> DataFrame:
    """``(id, ancestor, distance)`` for every node and each of its ancestors: one row per pair and so as many as the depths add up to.

    A round joins each node's ancestor ``2 ** k`` above with that ancestor's own pairs, so every pair is made once.
    """
    first = forest.filter("up IS NOT NULL")
    pairs = cut(first.select("id", F.col("up").alias("ancestor"), F.lit(1).alias("distance")), "pairs")
    out, jump, step = pairs, pairs, 1
    while not jump.isEmpty():
        above = out.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("next"), F.col("distance").alias("more"))
        found = jump.join(above, "ancestor").select("id", F.col("next").alias("ancestor"), (F.col("distance") + F.col("more")).alias("distance"))
        out = cut(out.unionByName(found), "pairs")
        step *= 2
        jump = out.filter(F.col("distance") == step)
    return out


def upline(users: DataFrame, node: str = "tree_user_id", parent: str = "sponsor_id") -> DataFrame:
    """``(tree_user_id, upline_id)``: the closure of a sponsor tree; members on or below a cycle have no upline."""
    forest, _ = split_cycles(users, node, parent)
    return ancestors(forest).select(F.col("id").alias(node), F.col("ancestor").alias("upline_id"))


def _doubled(forest: DataFrame, down: Mapping[str, Column], up: Mapping[str, Column]) -> DataFrame:
    """``(id, ...)``: each ``down`` measure added up over a node and all its ancestors, each ``up`` one over its subtree."""
    rows = cut(forest.select("id", "up", *(F.coalesce(c, F.lit(0)).alias(n) for n, c in {**down, **up}.items())), "doubling")
    while not rows.filter("up IS NOT NULL").isEmpty():
        above = rows.select(F.col("id").alias("up"), F.col("up").alias("_next"), *(F.col(n).alias(f"_{n}") for n in down))
        below = rows.filter("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(*(F.sum(n).alias(f"_{n}") for n in up)) if up else None
        rows = rows.filter("up IS NOT NULL").join(above, "up").unionByName(
            rows.filter("up IS NULL").withColumns({"_next": F.col("up"), **{f"_{n}": F.lit(0).cast(rows.schema[n].dataType) for n in down}}))
        rows = rows.select("id", F.col("_next").alias("up"), *((F.col(n) + F.col(f"_{n}")).alias(n) for n in down), *up)
        if up:
            rows = rows.join(below, "id", "left").select("id", "up", *down, *((F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in up))
        rows = cut(rows, "doubling")
    return rows.drop("up")


def nested_sets(forest: DataFrame) -> DataFrame:
    """``(id, up, depth, size, lft, rgt)``: the intervals of a walk around the forest, children and roots by id.

    A node's interval holds exactly those of its subtree. ``lft`` is one more than its parent's plus two for every node
    in the subtrees of its elder siblings; these steps are running totals among siblings, made in ranges, so no task
    holds all children of one parent, and add up along the path from the root.
    """
    sizes = _doubled(forest, {"depth": F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long")}, {"size": F.lit(1).cast("long")})
    nodes = cut(forest.join(sizes, "id"), "nodes")
    elder = running_total(nodes.withColumn("_up", F.col("up")), ["_up"], ["id"], "size", "elder").drop("_up")
    steps = elder.select("id", "up", "depth", "size", (1 + 2 * (F.col("elder") - F.col("size"))).alias("step"))
    steps = cut(steps, "steps")
    left = _doubled(steps, {"lft": F.col("step")}, {})
    return steps.drop("step").join(left, "id").withColumn("rgt", F.col("lft") + 2 * F.col("size") - 1)


def subtree_sums(intervals: DataFrame, facts: DataFrame, measures: Mapping[str, Column], node: str = "id") -> DataFrame:
    """``(id, ...)``: measures of ``facts``, added up per node, over every node's subtree, by its interval.

    The walk's order makes a subtree a range of places, so its sum is the difference of two running totals, found
    by equality of places: no comparison of intervals and no pair of node and descendant.
    """
    per_node = facts.groupBy(F.col(node).alias("id")).agg(*(F.sum(c).alias(n) for n, c in measures.items()))
    placed = intervals.select("id", "size", ((F.col("lft") + 1 + F.col("depth")) / 2).cast("long").alias("place"))
    rows = placed.join(per_node, "id", "left").na.fill(0, list(measures))
    for name in measures:
        rows = running_total(rows, [], ["place"], name, f"_to_{name}")
    rows = cut(rows, "places")
    ends = rows.select(F.col("place").alias("end"), *(F.col(f"_to_{n}").alias(f"_end_{n}") for n in measures))
    found = rows.withColumn("end", F.col("place") + F.col("size") - 1).join(ends, "end")
    return found.select("id", *((F.col(f"_end_{n}") - F.col(f"_to_{n}") + F.col(n)).alias(n) for n in measures))
