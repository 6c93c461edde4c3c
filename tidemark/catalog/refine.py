"""Version operators, refine jobs and assemblies on lake tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.adapters import Lake, Star
from tidemark.catalog.base import FIRST, LAST, query
from tidemark.operators import versions
from tidemark.plans import refine

# ---- versions and refine jobs --------------------------------------------------

RULES = config.Rules(
    {"america": config.PASS_THROUGH, "europe": config.NORMALIZED, "africa": config.NORMALIZED}
)


def tenant_table(s: Star) -> DataFrame:
    """Tenant dimension: every region but one, so unknown tenants occur."""
    return s.table("region").filter("r_name <> 'ASIA'").selectExpr(
        "lower(r_name) AS client", "CAST(r_regionkey + 1 AS BIGINT) AS partition_id", "concat('p-', lower(r_name)) AS partner_id"
    )


def lake_tables(s: Star) -> Lake:
    return Lake(s)


@query("latest_version")
def _(s: Star) -> DataFrame:
    rows = s.lake_order_items().select("client", "id", "event_id", "ingested_at", "order_id", "product_id", "quantity", "price_total")
    return versions.latest_by(rows, ["client", "id"]).drop("ingested_at")


@query("latest_version_mixed_order")
def _(s: Star) -> DataFrame:
    return versions.latest_by(s.lake_contact_categories(), ["client", "id"], versions.earliest_event()).drop("ingested_at")


def _window_profile(rows: DataFrame) -> DataFrame:
    return rows.groupBy("client").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))


@query("window_closed")
def _(s: Star) -> DataFrame:
    return _window_profile(versions.in_window(s.lake_tree_users(), FIRST, LAST))


@query("window_half_open")
def _(s: Star) -> DataFrame:
    return _window_profile(versions.in_window(s.lake_tree_users(), FIRST, LAST, lower_inclusive=False))


@query("changed_ids")
def _(s: Star) -> DataFrame:
    return versions.changed_ids([(s.lake_orders(), "id"), (s.lake_order_items(), "order_id")], "order_id", FIRST, LAST)


def user_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "client_partition_id", "client_partner_id", "client", "tree_user_id", "user_id", "sponsor_id", "zip", "modified", "client_type",
        "client_status", "client_paid_rank", "client_paid_rank_level", "client_lifetime_rank", "client_lifetime_rank_level",
        "event_id", "type", "status",
    )


def contact_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "client_partition_id", "client", "id", "last_name", "event_id", "owner_tree_user_id", "owner_user_id", "tree_user_id", "user_id",
        F.size("emails").cast("long").alias("emails"),
        F.expr("array_join(transform(emails, e -> concat(e.email, ':', e.preferred, ':', e.undeliverable_count)), ',')").alias("email_list"),
        F.size("phone_numbers").cast("long").alias("phones"),
        F.expr("array_join(transform(phone_numbers, p -> p.phone_number), ',')").alias("phone_list"),
        F.col("categories")[0]["category"].alias("category"),
        F.to_date(F.col("categories")[0]["created_at"]).alias("linked"),
    )


@query("staging_users")
def _(s: Star) -> DataFrame:
    return user_rows(refine.staging_users(lake_tables(s), tenant_table(s), RULES, FIRST, LAST))


@query("staging_orders_nested")
def _(s: Star) -> DataFrame:
    rows = refine.staging_orders(lake_tables(s), tenant_table(s), RULES, FIRST, LAST)
    return rows.select(
        "client_partition_id", "client", "order_id", "tree_user_id", "client_type", "client_status", "is_autoship", "total", "ingested_at",
        F.coalesce(F.size("products"), F.lit(0)).cast("long").alias("products"),
        F.expr("aggregate(products, CAST(0 AS DECIMAL(29,4)), (a, p) -> CAST(a + p.price_total AS DECIMAL(29,4)))").alias("items_total"),
        F.expr("array_join(transform(products, p -> concat(p.product_code, ':', p.quantity)), ',')").alias("codes"),
        "type", "status", "commission_user_id",
    )


@query("staging_contacts")
def _(s: Star) -> DataFrame:
    return contact_rows(refine.staging_contacts(lake_tables(s), tenant_table(s), FIRST, LAST))


@query("pii_users")
def _(s: Star) -> DataFrame:
    return refine.pii_users(lake_tables(s), tenant_table(s), FIRST, LAST).drop("ingested_at")
