"""Versioned (append-only) tables: windows, changed ids and latest version."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TENANT = "client"
EVENT = "event_id"
INGESTED = "ingested_at"
# Partition column of lake tables: the day of ``ingested_at``.
INGEST_DAY = "ingest_date"


def newest_first() -> list[Column]:
    """Later event wins; of one event replayed, the later ingest wins."""
    return [F.col(EVENT).desc(), F.col(INGESTED).desc()]


def earliest_event() -> list[Column]:
    """Earliest event, of it the latest ingest (used by contact categories)."""
    return [F.col(EVENT).asc(), F.col(INGESTED).desc()]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first row per key in the given order (default: newest version).

    ``row_number() = 1`` becomes a WindowGroupLimit, which already keeps one row
    per key on the map side, so a hot key sends one row per task to the shuffle.
    """
    ranked = W.partitionBy(*keys).orderBy(*(order or newest_first()))
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def in_window(df: DataFrame, first, last, column: str = INGESTED, lower_inclusive: bool = True) -> DataFrame:
    """Rows ingested in ``[first, last]``, or ``(first, last]``.

    On a table partitioned by ``ingest_date`` only the window's days are read.
    """
    kind = df.schema[column].dataType
    low, high = F.lit(first).cast(kind), F.lit(last).cast(kind)
    moment = F.col(column)
    rows = df.filter((moment >= low if lower_inclusive else moment > low) & (moment <= high))
    if INGEST_DAY in df.columns:
        rows = rows.filter(F.col(INGEST_DAY).between(low.cast("date"), high.cast("date")))
    return rows


def union_all(frames: Iterable[DataFrame], distinct: bool = False) -> DataFrame:
    """UNION ALL by column name, or UNION DISTINCT."""
    merged = reduce(DataFrame.unionByName, frames)
    return merged.distinct() if distinct else merged


def changed_ids(
    sources: Sequence[tuple[DataFrame, str]], key: str, first, last, lower_inclusive: bool = True
) -> DataFrame:
    """Distinct ``(client, key)`` touched in the window by any source.

    Each source names its own column that holds the parent's key, so a change in
    a child table re-emits the parent.
    """
    return union_all(
        (
            in_window(df, first, last, lower_inclusive=lower_inclusive)
            .select(TENANT, F.col(own).alias(key))
            .filter(F.col(key).isNotNull())
            for df, own in sources
        ),
        distinct=True,
    )


def history_of(df: DataFrame, ids: DataFrame, own: str, key: str) -> DataFrame:
    """Full history (not only the window) of the changed entities."""
    wanted = ids.select(TENANT, F.col(key).alias(own)) if own != key else ids
    return df.join(wanted, [TENANT, own], "left_semi")


def current_state(df: DataFrame, ids: DataFrame, own: str, key: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Latest version, over full history, of the changed entities."""
    return latest_by(history_of(df, ids, own, key), keys or [TENANT, own])
