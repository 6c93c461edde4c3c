"""Assembly jobs, back-fill, updates and flat report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.adapters import Star
from tidemark.catalog.base import AS_OF, FIRST, query
from tidemark.catalog.refine import lake_tables, tenant_table
from tidemark.operators import changes, joins, versions
from tidemark.plans import assembly, incremental, refine
from tidemark.plans import rules as tenant_rules
from tidemark.session import cut
from tidemark.sources import tables

TENANT = "europe"


# ---- messages and links -------------------------------------------------------------


def _messages(s: Star) -> DataFrame:
    """One message per conversation; senders are users or contacts."""
    return s.table("conversations").groupBy("conv_id").agg(F.count("*").alias("turns")).selectExpr(
        "conv_id AS id",
        f"conv_id % {s.customer_count()} AS sender_id",
        "CASE WHEN conv_id % 2 = 0 THEN 'User' ELSE 'PyrCrm::Contact' END AS sender_type",
        "concat('subject ', conv_id) AS subject", "turns AS internal_recipient_count",
        "timestampadd(DAY, conv_id % 400, timestamp_ntz'1995-01-01 00:00:00') AS created_at",
    )


def _recipients(s: Star) -> DataFrame:
    """One recipient per turn, of a kind by role; every fifth is no e-mail."""
    return s.table("conversations").selectExpr(
        "conv_id AS message_id",
        f"(conv_id * 7 + turn) % {s.customer_count()} AS recipient_id",
        "CASE role WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'PyrCrm::Contact' ELSE 'PyrTree::User' END AS recipient_type",
        "CASE WHEN (conv_id + turn) % 5 > 0 THEN 'email' ELSE 'sms' END AS delivery_type",
        "turn AS opened_count",
    )


def _people(s: Star) -> tuple[DataFrame, DataFrame, DataFrame]:
    customer = s.table("customer")
    users = customer.selectExpr("c_custkey AS id", "c_custkey + 5000000 AS tree_user_id")
    contacts = customer.selectExpr("c_custkey AS id", "CASE WHEN c_custkey % 3 > 0 THEN c_custkey + 9000000 END AS tree_user_id")
    return users, contacts, customer.selectExpr("c_custkey AS id")


@query("polymorphic_lookup")
def _(s: Star) -> DataFrame:
    users, contacts, tree_users = _people(s)
    rows = joins.polymorphic_lookup(
        _recipients(s), "recipient_type", "recipient_id",
        {"User": (users, "id", "tree_user_id"), "PyrCrm::Contact": (contacts, "id", "tree_user_id"), "PyrTree::User": (tree_users, "id", "id")},
        "recipient_tree_user_id",
    )
    return rows.select("message_id", "recipient_id", "recipient_type", "opened_count", "recipient_tree_user_id")


def emails(s: Star) -> DataFrame:
    return assembly.staging_emails(_messages(s), _recipients(s), *_people(s), tenant_table(s), TENANT)


@query("staging_emails")
def _(s: Star) -> DataFrame:
    rows = emails(s)
    return rows.select(
        "client", "client_partition_id", "message_id", "sender_tree_user_id", "subject", "message_created_at",
        F.size("recipients").cast("long").alias("recipients"),
        F.expr("array_join(transform(recipients, r -> coalesce(CAST(r.recipient_tree_user_id AS STRING), '-')), ',')").alias("who"),
    )


@query("flat_emails")
def _(s: Star) -> DataFrame:
    rows = assembly.flat_emails(_messages(s), _recipients(s), *_people(s))
    return rows.select("message_id", "message_tree_user_id", "recipient_tree_user_id", "recipient_type", "opened_count", "subject")


@query("staging_links")
def _(s: Star) -> DataFrame:
    pages, documents, labels = s.table("pages"), s.table("documents"), s.table("labels")
    links = pages.selectExpr(
        "page_id AS id", f"page_id % {s.customer_count()} AS user_id",
        "timestampadd(DAY, page_id % 300, timestamp_ntz'1995-01-01 00:00:00') AS created_at", "page_id AS asset_id",
        "CASE WHEN page_id % 3 > 0 THEN 'PyrCore::ResourceAsset' ELSE 'PyrCrm::Ecard' END AS asset_type",
        "page_id + 1 AS containable_id", "'PyrPwp::Site' AS containable_type", "page_id + 2 AS channel_id", "'PyrCrm::Sms' AS channel_type",
    )
    assets = documents.selectExpr(
        "doc_id AS id", "doc_id AS resource_id", "source AS title", "lang AS file_type", "concat('f', doc_id) AS file_name",
        "substring(text, 1, 0) AS file_description", "doc_id % 2 AS available_email", "CAST(NULL AS INT) AS allow_download",
        "n_chars AS likes_count", "doc_id AS shares_count", "0 AS abuse_reports_count", "0 AS views_count", "0 AS downloads_count",
        "timestamp_ntz'1995-01-01 00:00:00' AS created_at", "timestamp_ntz'1995-01-01 00:00:00' AS updated_at",
    )
    resources = labels.selectExpr(
        "doc_id AS id", "concat('quality ', quality) AS title", "timestamp_ntz'1995-01-01 00:00:00' AS created_at",
        "timestamp_ntz'1995-01-02 00:00:00' AS updated_at", "CAST(NULL AS TIMESTAMP_NTZ) AS expiry_date",
    )
    rows = assembly.staging_links(links, assets, resources, s.users().filter(f"client = '{TENANT}'"))
    a = "resource_asset"
    return rows.select(
        "link_id", "link_sharer_id", "created_at", "asset_type", F.col(f"{a}.title").alias("title"), F.col(f"{a}.file_type").alias("file_type"),
        F.col(f"{a}.can_email").alias("can_email"), F.col(f"{a}.likes_count").alias("likes"),
        F.col(f"{a}.resource.resource_id").alias("resource_id"), F.col(f"{a}.resource.title").alias("resource_title"),
    )


def _sites(s: Star) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    n = s.table("supplier").count()
    sites = s.table("supplier").selectExpr("s_suppkey AS id", "CASE WHEN s_suppkey % 11 > 0 THEN CAST(s_suppkey AS STRING) ELSE 'none' END AS user_id",
                                            "CASE WHEN s_suppkey % 5 > 0 THEN timestampadd(DAY, s_suppkey % 400, timestamp_ntz'1995-01-01 00:00:00') END AS created_at")
    visitors = s.table("events").filter("event_type = 'view'").selectExpr(
        f"(user_id * 2) % {n} AS site_id", "event_id AS visitor_id", "ts AS last_visit_date", "CAST(value AS BIGINT) AS visit_count",
        "'127.0.0.1' AS ipaddress", "props AS browser_agent", "ts AS created_at",
    )
    users = s.table("customer").selectExpr("c_custkey AS id", "c_custkey * 2 AS tree_user_id")
    codes = s.table("customer").filter("c_custkey % 2 = 0").selectExpr("c_custkey AS user_id", "c_mktsegment AS third_party_tracking_company", "c_name AS tracking_code")
    return sites, visitors, users, codes


@query("site_visitors")
def _(s: Star) -> DataFrame:
    return assembly.site_visitors(*_sites(s), TENANT)


def sites(s: Star) -> DataFrame:
    return assembly.staging_sites(*_sites(s), tenant_table(s), TENANT)


def visits(s: Star) -> DataFrame:
    return assembly.site_visitors(*_sites(s), TENANT)


@query("staging_sites")
def _(s: Star) -> DataFrame:
    return sites(s).select(
        "client", "client_partition_id", "site_id", "user_id", "tree_user_id", "created_at", F.coalesce(F.size("visitors"), F.lit(0)).cast("long").alias("visitors"),
        F.expr("aggregate(visitors, 0L, (a, v) -> a + v.visit_count)").alias("visits"), F.expr("array_join(analytics_tracking_codes.tracking_code, ',')").alias("codes"),
    )


def task_rows(s: Star) -> DataFrame:
    raw = s.table("documents").selectExpr(
        "doc_id AS id", "text AS task_title", "lang AS description", "timestamp_ntz'1996-01-01 00:00:00' AS due_date",
        "doc_id * 3 AS user_id", "CASE WHEN source = 'src1' THEN 'system' WHEN source = 'src2' THEN NULL ELSE source END AS source",
        "n_chars % 5 AS priority", "timestamp_ntz'1995-06-01 00:00:00' AS created_at", "CAST(NULL AS TIMESTAMP_NTZ) AS completed_at",
    )
    users = s.table("customer").selectExpr("c_custkey AS id", "c_custkey + 1 AS tree_user_id")
    return assembly.tasks(raw, users)


@query("tasks")
def _(s: Star) -> DataFrame:
    return task_rows(s).withColumn("task_title", F.md5("task_title"))


# ---- back-fill and updates -------------------------------------------------------------


def _latest(s: Star, table: str) -> DataFrame:
    return versions.latest_by(lake_tables(s)[table], ["client", "id"]).filter(F.col("client") == TENANT)


@query("backfill_users")
def _(s: Star) -> DataFrame:
    raw = _latest(s, "tree_users").drop("client")
    dims = [_latest(s, t) for t in ("tree_user_types", "tree_user_statuses")]
    users = s.lake_users().filter(F.col("client") == TENANT)
    rows = assembly.backfill_users(raw, users, *dims, tenant_table(s), TENANT)
    return tenant_rules.update_user_types(rows, TENANT).drop("ingested_at")


@query("member_types_update")
def _(s: Star) -> DataFrame:
    rows = s.users().selectExpr(
        "client", "tree_user_id", "CASE WHEN tree_user_id % 3 = 0 THEN 'Kept' ELSE 'tbd' END AS type", "'tbd' AS status",
        "CASE tree_user_id % 5 WHEN 0 THEN 'MEMBER' WHEN 1 THEN 'RETAIL' WHEN 2 THEN 'BA' WHEN 3 THEN 'PC' ELSE 'other' END AS client_type",
        "client_type AS client_status",
    )
    return tenant_rules.update_member_types(rows, TENANT)


@query("backfill_orders")
def _(s: Star) -> DataFrame:
    users = s.users().select("client", "tree_user_id", "sponsor_id", "coded", "type")
    raw = versions.latest_by(s.lake_orders(), ["client", "id"])
    items = cut(versions.latest_by(s.lake_order_items(), ["client", "id"]), "items")  # read twice, to count and to nest
    types, statuses = _latest(s, "tree_order_types"), _latest(s, "tree_order_statuses")
    rows = assembly.backfill_orders(raw, items, types, statuses, users, tenant_table(s), TENANT)
    rows = tenant_rules.update_order_status(rows, TENANT)
    return rows.select(
        "client", "order_id", "commission_user_id", "tree_user_id", "type", "status", "client_type", "client_status", "is_autoship", "total",
        F.coalesce(F.size("products"), F.lit(0)).cast("long").alias("products"),
    )


@query("orders_from_users_update")
def _(s: Star) -> DataFrame:
    orders = s.orders().join(s.users().select("tree_user_id", "client"), "tree_user_id").select(
        "client", "order_id", "tree_user_id", "commission_user_id", "type", "order_date"
    )
    return tenant_rules.update_orders_from_users(orders, s.users(), TENANT)


@query("order_codes")
def _(s: Star) -> DataFrame:
    code = F.substring(F.lit("BCDEIRXYZ"), F.pmod(F.col("l_partkey"), F.lit(9)).cast("int") + 1, F.lit(1))
    rows = s.table("lineitem").select(code.alias("code"), "l_quantity")
    return rows.groupBy("code", tenant_rules.order_code_type(F.col("code")).alias("type")).agg(F.count("*").alias("n"))


@query("backfill_pii")
def _(s: Star) -> DataFrame:
    return assembly.backfill_pii(_latest(s, "tree_users").drop("client"), tenant_table(s), TENANT).drop("ingested_at")


# ---- flat tables ------------------------------------------------------------------------


def _commissions(s: Star) -> DataFrame:
    orders = s.table("orders")
    month = "year(o_orderdate) * 100 + month(o_orderdate)"
    earned = orders.groupBy("o_custkey", F.expr(month).alias("run")).agg(F.sum(F.col("o_totalprice").cast("decimal(19,4)")).alias("earnings")).selectExpr(
        "o_custkey AS tree_user_id", "run AS commission_run_id", "'USD' AS currency_code", "earnings"
    )
    runs = orders.selectExpr(f"{month} AS id", "year(o_orderdate) * 10 + quarter(o_orderdate) AS period_id", "date_trunc('MONTH', o_orderdate) AS run_date").distinct()
    periods = orders.selectExpr("year(o_orderdate) * 10 + quarter(o_orderdate) AS id", "quarter(o_orderdate) % 2 + 1 AS period_type_id",
                                "concat(year(o_orderdate), '-Q', quarter(o_orderdate)) AS description").distinct()
    kinds = s.table("region").filter("r_regionkey < 2").selectExpr("r_regionkey + 1 AS id", "r_name AS description")
    return assembly.commissions(s.users(), earned, runs, periods, kinds)


@query("commissions")
def _(s: Star) -> DataFrame:
    return _commissions(s).withColumn("run_date", F.to_date("run_date"))


@query("commissions_nested")
def _(s: Star) -> DataFrame:
    return assembly.nested_commissions(_commissions(s)).select(
        "tree_user_id", F.size("runs").cast("long").alias("runs"),
        F.expr("aggregate(runs, CAST(0 AS DECIMAL(29,4)), (a, r) -> CAST(a + r.earnings AS DECIMAL(29,4)))").alias("earnings"),
        F.expr("runs[0].run_id").alias("first_run"),
    )


@query("order_items_flat")
def _(s: Star) -> DataFrame:
    orders = versions.latest_by(s.lake_orders(), ["client", "id"])
    items = versions.latest_by(s.lake_order_items(), ["client", "id"])
    rows = assembly.order_items_flat(orders, items, _latest(s, "tree_order_types"), _latest(s, "tree_order_statuses"))
    return rows.select("order_id", "order_item_id", "tree_user_id", "type", "status", "is_autoship", "total", "product_id", "product_code",
                       "quantity", "price_total", "item_tracking_number", "client_user_id")


@query("demographics")
def _(s: Star) -> DataFrame:
    dims = [_latest(s, t) for t in ("tree_user_types", "tree_user_statuses")]
    return assembly.demographics(_latest(s, "tree_users"), s.lake_users(), *dims, AS_OF)


def reviews(s: Star) -> DataFrame:
    rated = s.table("documents").selectExpr(
        "concat('reviewer ', doc_id) AS name", "lang AS location", "CAST(1 + n_chars % 5 AS INT) AS rating", "source AS title", "text AS review",
        "doc_id % 2 = 0 AS approved", "timestampadd(DAY, doc_id % 700, timestamp_ntz'1996-01-01 00:00:00') AS created_at",
        "timestampadd(DAY, doc_id % 900, timestamp_ntz'1996-01-01 00:00:00') AS updated_at", "doc_id AS user_id", "'127.0.0.1' AS ip_address",
        "lang AS locale", "TRUE AS show_identifier", "doc_id * 3 AS product_id",
    )
    users = s.table("customer").selectExpr("c_custkey AS id", "c_custkey + 7 AS tree_user_id")
    products = s.table("part").selectExpr(
        "p_partkey AS id", "p_name AS name", "p_type AS description", "p_brand AS short_description", "timestamp_ntz'1995-01-01 00:00:00' AS available_on",
        "CAST(NULL AS TIMESTAMP_NTZ) AS discontinue_on", "replace(p_name, ' ', '-') AS slug", "CAST(p_size % 6 AS DECIMAL(7,5)) AS avg_rating", "p_size AS reviews_count",
    )
    variants = s.table("part").selectExpr("p_partkey AS product_id", "concat(p_brand, '-', p_partkey) AS sku")
    return assembly.product_reviews(rated, users, products, variants)


@query("product_reviews")
def _(s: Star) -> DataFrame:
    return reviews(s).withColumn("review", F.md5("review"))


# ---- keyed changes, windows and key ranges -------------------------------------------------


def _item_versions(s: Star) -> DataFrame:
    return s.lake_order_items().select("client", "id", "event_id", "ingested_at", "product_id", "quantity")


@query("upsert_by_key")
def _(s: Star) -> DataFrame:
    rows = _item_versions(s)
    split = F.lit("1999-01-01").cast("timestamp_ntz")
    target = versions.latest_by(rows.filter(F.col("ingested_at") < split), ["client", "id"])
    return changes.upsert(target, rows.filter(F.col("ingested_at") >= split), ["client", "id"], versions.newest_first())


@query("next_window")
def _(s: Star) -> DataFrame:
    sources = {"tree_orders": s.lake_orders(), "tree_order_items": s.lake_order_items()}
    return incremental.upper_bound(sources, FIRST).select(F.lit(FIRST).alias("first"), "last", F.col("last").isNotNull().alias("has_data"))


@query("key_range_read")
def _(s: Star) -> DataFrame:
    return tables.key_range_read(s.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 4)


@query("filtered_export_source")
def _(s: Star) -> DataFrame:
    rows = refine.refined_users(lake_tables(s), tenant_table(s), FIRST, AS_OF)
    even = s.table("customer").where("c_custkey % 2 = 0").select("c_custkey")
    some = tables.filtered(rows, (FIRST, AS_OF), even, "1995-06-01", tables=config.EXPORT_TABLES, table="staging.users")
    return some.select("client", "tree_user_id", "created", "client_type", "ingested_at")


@query("text_key_join")
def _(s: Star) -> DataFrame:
    left = s.table("orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END AS who")
    return joins.join_on_number(left, s.table("customer").select("c_custkey", "c_mktsegment"), "who", "c_custkey").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("rank_fan_out")
def _(s: Star) -> DataFrame:
    """Lookup keys that would multiply rows: rank levels shared by several ranks."""
    return joins.duplicate_keys(s.lake_ranks(), ["level"])
