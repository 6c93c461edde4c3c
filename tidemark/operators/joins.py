"""Joins the reports and staging jobs need beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.versions import TENANT, latest_by, union_all


def lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str], how: str = "left") -> DataFrame:
    """Add ``take`` (new name -> dimension column) by ``on`` (own column -> dimension column)."""
    side = dim.select(
        *(F.col(theirs).alias(f"_on_{own}") for own, theirs in on.items()),
        *(F.col(theirs).alias(new) for new, theirs in take.items()),
    )
    matched = [F.col(own) == F.col(f"_on_{own}") for own in on]
    return df.join(side, matched, how).drop(*(f"_on_{own}" for own in on))


def lookup_latest(df: DataFrame, lake: DataFrame, own: str, take: Mapping[str, str], key: str = "id") -> DataFrame:
    """Left lookup of the latest version of a tenant's dimension row."""
    needed = {TENANT, "id", key, *take.values(), "event_id", "ingested_at"}
    dim = latest_by(lake.select(*sorted(needed)), [TENANT, "id"])
    return lookup(df, dim, {TENANT: TENANT, own: key}, take)


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a dimension (a lookup by them would fan out)."""
    return dim.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def with_tenant(df: DataFrame, tenants: DataFrame) -> DataFrame:
    """Attach the tenant dimension; rows of unknown tenants are dropped."""
    side = tenants.select(
        TENANT,
        F.col("partition_id").alias("client_partition_id"),
        F.col("partner_id").alias("client_partner_id"),
    )
    return df.join(side, TENANT, "inner")


def for_tenant(df: DataFrame, tenant: str) -> DataFrame:
    """Rows of one tenant, whatever the case it is written in."""
    return df.filter(F.lower(TENANT) == tenant.lower())


def attach_tenant(df: DataFrame, tenants: DataFrame, tenant: str) -> DataFrame:
    """Give rows that name no tenant the one dimension row of ``tenant``."""
    return with_tenant(df.withColumn(TENANT, F.lit(tenant)), tenants)


def polymorphic_lookup(
    df: DataFrame,
    kind: str,
    ref: str,
    targets: Mapping[str, tuple[DataFrame, str, str | Column]],
    out: str,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Resolve ``(kind, ref)`` against several tables with one join.

    ``targets`` maps a kind to (table, id column, value). ``extra`` adds equality
    columns (for example the tenant) shared by both sides.
    """
    union = union_all(
        table.select(
            *(F.col(c).alias(f"_x_{c}") for c in extra),
            F.lit(name).alias("_kind"),
            F.col(key).cast("long").alias("_ref"),
            (F.col(value) if isinstance(value, str) else value).alias(out),
        )
        for name, (table, key, value) in targets.items()
    )
    on = [F.col(kind) == F.col("_kind"), F.col(ref) == F.col("_ref")]
    on += [F.col(c) == F.col(f"_x_{c}") for c in extra]
    return df.join(union, on, "left").drop("_kind", "_ref", *(f"_x_{c}" for c in extra))


def keep_all(one: DataFrame, many: DataFrame, on: str) -> DataFrame:
    """Left join of rows with their many partners, as inner join plus lonely rows.

    An outer join cannot be split on its optional side, so one row with a large
    part of all partners would be one task; the inner join can.
    """
    matched = one.join(many, on)
    lonely = one.join(many.select(on).distinct(), on, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def join_on_number(df: DataFrame, other: DataFrame, text_key: str, key: str, how: str = "inner") -> DataFrame:
    """Join a numeric key kept as text; text that is no number never matches."""
    return df.join(other, F.col(text_key).try_cast("long") == F.col(key), how)
