"""Joins of points with the spans that hold them, by equality of bins and an exact test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Points of one key and bin that one task may take; more are dealt out to several, and the spans of the bin with them.
CROWD = 100_000


def _ticks(column: str, kind: T.DataType) -> Column:
    """A whole number that orders like the column: microseconds, days or the number itself."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    raise TypeError(f"{column} is no time, date or whole number")


def within(
    points: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, low: str, high: str, crowd: int = CROWD,
) -> DataFrame:
    """Every point joined with every span of equal ``keys`` that holds it: ``low <= at <= high``.

    A span belongs to the level whose bins are just as wide as itself or wider, a power of two, and so to one or two
    bins there, however long it is; a point is looked up once on each level that occurs. The pairs of a bin then pass
    the exact test. Bins with more than ``crowd`` points are dealt out by a hash of the point, and their spans copied
    to each part, so neither a hot key nor a crowded moment is one task.

    Rows with a null key, point or bound have no partner, and a span that ends before it begins holds nothing. Columns
    of the spans named like columns of the points, but for the keys, are to be renamed before.
    """
    clash = (set(points.columns) & set(spans.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    kinds = [_ticks(c, df.schema[c].dataType) for df, c in ((points, at), (spans, low), (spans, high))]
    ranged = spans.withColumns({"_low": kinds[1], "_high": kinds[2]}).filter(F.col("_low") <= F.col("_high"))
    # bits of the length: bins of 2 ** level ticks are at least as wide as the span
    level = F.length(F.bin(F.col("_high") - F.col("_low")))
    ranged = ranged.withColumn("_level", F.when(F.col("_high") == F.col("_low"), 0).otherwise(level))
    bins = F.sequence(F.expr("shiftright(_low, _level)"), F.expr("shiftright(_high, _level)"))
    binned = ranged.withColumn("_bin", F.explode(bins))
    levels = [r[0] for r in ranged.select("_level").distinct().collect()]  # at most 64
    if not levels:
        return points.limit(0).join(spans, list(keys))
    placed = points.withColumn("_at", kinds[0]).filter(F.col("_at").isNotNull())
    placed = placed.withColumn("_level", F.explode(F.array(*(F.lit(x) for x in sorted(levels))))).withColumn("_bin", F.expr("shiftright(_at, _level)"))
    place = [*keys, "_level", "_bin"]
    parts = placed.groupBy(*place).agg(F.ceil(F.count("*") / crowd).cast("int").alias("_parts")).filter("_parts > 1")
    salted = placed.join(parts, place, "left").withColumn("_part", F.when(F.col("_parts") > 1, F.pmod(F.xxhash64(*points.columns), F.col("_parts"))).otherwise(0).cast("int"))
    copied = binned.join(parts, place, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    # Spark's estimate of an explode is that of its input: points on many levels would pass for a small side and be broadcast
    found = salted.drop("_parts").hint("merge").join(copied.drop("_parts"), [*place, "_part"])
    held = found.filter((F.col("_at") >= F.col("_low")) & (F.col("_at") <= F.col("_high")))
    return held.select(*points.columns, *(c for c in spans.columns if c not in keys))
