"""Child rows as nested arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Children one output row may hold. The grain of a nested table is (key, part): a
# parent with more children (one mailing to millions) has several parts, so no row
# or task holds an unbounded array and no child is lost. Every table carries
# ``part`` and ``parts``; what belongs to the parent alone is read from part 0.
CHILD_LIMIT = 100_000


@dataclass(frozen=True)
class Child:
    """Rows to nest, the fields of one element, and the columns that identify a child.

    The rows are read twice, to count and to nest; write costly ones once (``cut``).
    """

    rows: DataFrame
    fields: Sequence[str | Column]
    ids: Sequence[str] = ()


def nest_many(children: Mapping[str, Child], keys: Sequence[str], limit: int | None = CHILD_LIMIT, part: str = "part") -> DataFrame:
    """``(keys, part, parts, one sorted array<struct> and one n_<name> per child table)``.

    All child tables go through one grouping. Parents above ``limit`` are found by
    a map-side count first; their children are spread over ``ceil(count / limit)``
    parts by a hash of the child's id and fields, so children that share an id, or
    have none, are spread as well. All
    other parents have the single part 0; a part that got no child is left out,
    but part 0 of a parent is always there. ``n_<name>`` counts the children of
    the parent, whatever part they are in and whatever the limit is.
    """
    names = list(children)
    rows = _union_by_name(
        [
            c.rows.select(*keys, F.struct(*c.fields).alias(n), F.xxhash64(*c.ids, F.struct(*c.fields)).alias("_hash"))
            for n, c in children.items()
        ]
    )
    if limit is None:
        spread = rows.withColumn(part, F.lit(0))
        totals = [F.lit(1).alias("parts")]
    else:
        counted = _union_by_name(
            [c.rows.select(*keys, F.lit(1).alias(f"_n_{n}")) for n, c in children.items()]
        )
        counts = counted.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.count(f"_n_{n}").alias(f"_n_{n}") for n in names))
        crowded = counts.filter(F.col("_n") > limit)
        spread = rows.join(crowded, list(keys), "left").withColumn(
            part,
            F.when(F.col("_n").isNull(), 0).otherwise(F.pmod("_hash", F.ceil(F.col("_n") / limit))).cast("int"),
        )
        # a crowded parent has its part 0 even if no child's hash falls there
        spread = spread.unionByName(crowded.select(*keys, "_n", F.lit(0).alias(part)), allowMissingColumns=True)
        totals = [F.max(f"_n_{n}").alias(f"_n_{n}") for n in names]
        totals.append(F.coalesce(F.max(F.ceil(F.col("_n") / limit)).cast("int"), F.lit(1)).alias("parts"))
    nested = spread.groupBy(*keys, part).agg(*(F.sort_array(F.collect_list(n)).alias(n) for n in names), *totals)
    for name in names:
        own = F.size(name).cast("long")
        nested = nested.withColumn(f"n_{name}", own if limit is None else F.coalesce(f"_n_{name}", own))
    return nested.drop(*(f"_n_{n}" for n in names))


def _union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


def nest_children(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str | Column], name: str, limit: int | None = CHILD_LIMIT,
    ids: Sequence[str] = (),
) -> DataFrame:
    """One child table: ``(keys, part, parts, name array<struct<fields>>)``."""
    return nest_many({name: Child(df, fields, ids)}, keys, limit).drop(f"n_{name}")

