"""Windowed refinement of lake versions into conformed tables.

Each job: ids changed in the window -> latest version over full history ->
children nested -> dimension lookups -> tenant rules.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Rules
from tidemark.functions.rules import flag, gender, street
from tidemark.operators.joins import lookup, lookup_latest, with_tenant
from tidemark.operators.nesting import CHILD_LIMIT, Child, nest_children, nest_many
from tidemark.operators.versions import changed_ids, earliest_event, history_of, in_window, latest_by
from tidemark.plans.rules import order_rules, user_rules
from tidemark.session import cut

Lake = Mapping[str, DataFrame]


def _versions(lake: Lake, table: str, ids: DataFrame, own: str, key: str) -> DataFrame:
    """Versions of the entities in ``ids``: those a lake picks by itself, as one with states (``plans.states``) its kept latest
    ones, else the full history."""
    known = lake.known(table, own, ids, key) if hasattr(lake, "known") else None
    return history_of(lake[table], ids, own, key) if known is None else known


def _state(lake: Lake, table: str, ids: DataFrame, own: str, key: str) -> DataFrame:
    """Latest version of the changed entities."""
    return latest_by(_versions(lake, table, ids, own, key), ["client", own])


def _referenced(lake: Lake, table: str, columns: list[str], rows: DataFrame, ref: str) -> DataFrame:
    """Latest version of only those entities that ``rows`` refer to."""
    return latest_by(_versions(lake, table, rows, "id", ref).select("client", "id", *columns, "event_id", "ingested_at"), ["client", "id"])


def refined_users(lake: Lake, tenants: DataFrame, first, last) -> DataFrame:
    """Latest state of users changed in ``[first, last]``, before tenant rules."""
    ids = cut(changed_ids([(lake["tree_users"], "id"), (lake["users"], "tree_user_id")], "tree_user_id", first, last), "ids")
    state = _state(lake, "tree_users", ids, "id", "tree_user_id")
    logins = _state(lake, "users", ids, "tree_user_id", "tree_user_id")
    complete = state.na.drop(subset=["sponsor_id", "user_type_id", "rank_id"])
    rows = lookup(with_tenant(complete, tenants), logins, {"client": "client", "id": "tree_user_id"}, {"user_id": "id"})
    rows = lookup_latest(rows, lake["tree_user_types"], "user_type_id", {"client_type": "description"})
    rows = lookup_latest(rows, lake["tree_user_statuses"], "user_status_id", {"client_status": "description"})
    # ranks are referred to by level, not by id
    ranks = {"client_paid_rank": "name", "client_paid_rank_level": "level"}
    rows = lookup_latest(rows, lake["pyr_rank_definitions"], "paid_rank_id", ranks, key="level")
    ranks = {"client_lifetime_rank": "name", "client_lifetime_rank_level": "level"}
    rows = lookup_latest(rows, lake["pyr_rank_definitions"], "rank_id", ranks, key="level")
    return rows.select(
        "client_partition_id", "client_partner_id", "client",
        F.col("id").alias("tree_user_id"), "user_id", "sponsor_id", "parent_id", "zip",
        F.col("created_date").alias("created"), F.col("updated_date").alias("modified"), F.col("coded_date").alias("coded"),
        "client_type", "client_status",
        F.lit("").alias("paid_rank"), F.lit(None).cast("long").alias("paid_rank_level"),
        "client_paid_rank", "client_paid_rank_level",
        F.lit("").alias("lifetime_rank"), F.lit(None).cast("long").alias("lifetime_rank_level"),
        "client_lifetime_rank", "client_lifetime_rank_level",
        "event_id", "ingested_at",
    )


def staging_users(lake: Lake, tenants: DataFrame, rules: Rules, first, last) -> DataFrame:
    return user_rules(refined_users(lake, tenants, first, last), rules)


PRODUCT_FIELDS = [
    "product_id", "product_code", "product_description", "quantity", "price_each", "price_total", "weight_each",
    "weight_total", "tax", "bv", "bv_each", "cv_each", "cv", "parent_product_id",
]
ITEM_SHIPPING = ["tracking_number", "shipping_city", "shipping_state", "shipping_zip", "shipping_county", "shipping_country"]
ORDER_FIELDS = [
    "order_date", "currency_code", "total", "sub_total", "tax_total", "shipping_total", "bv_total", "cv_total",
    "discount_total", "discount_code", "timezone", "shipped_date", "shipping_city", "shipping_state", "shipping_zip",
    "shipping_country", "shipping_county", "tracking_number",
]


def refined_orders(lake: Lake, tenants: DataFrame, first, last, type_needs_user: bool = True, child_limit: int = CHILD_LIMIT) -> DataFrame:
    """Latest state of orders changed in the window, with their items nested.

    ``type_needs_user`` keeps the order type NULL where the buyer is unknown to
    the tenant, as the lookup runs through the buyer's tenant.
    """
    ids = cut(changed_ids([(lake["tree_orders"], "id"), (lake["tree_order_items"], "order_id")], "order_id", first, last), "ids")
    orders = _state(lake, "tree_orders", ids, "id", "order_id")
    items = latest_by(_versions(lake, "tree_order_items", ids, "order_id", "order_id"), ["client", "id"])
    items = cut(items.select("client", "order_id", "id", *PRODUCT_FIELDS, *ITEM_SHIPPING), "items")
    fields = [*PRODUCT_FIELDS, *(F.col(c).alias(f"item_{c}") for c in ITEM_SHIPPING)]
    products = nest_children(items, ["client", "order_id"], fields, "products", child_limit, ["id"])
    # an order is one row here, so its keys alone go to the buyers, and what is found there comes back
    keys = cut(orders.select("client", F.col("id").alias("order"), F.col("tree_user_id").alias("buyer")), "buyers")
    buyers = _referenced(lake, "tree_users", ["sponsor_id", "user_type_id"], keys, "buyer")
    found = {"tree_user_id": "id", "sponsor_id": "sponsor_id", "user_type_id": "user_type_id"}
    bought = lookup(keys, buyers, {"client": "client", "buyer": "id"}, found, "inner")
    rows = lookup(with_tenant(orders.drop("tree_user_id"), tenants), bought, {"client": "client", "id": "order"}, {c: c for c in found})
    rows = lookup_latest(rows, lake["tree_user_types"], "user_type_id", {"client_user_type": "description"})
    rows = lookup_latest(rows, lake["tree_order_statuses"], "order_status_id", {"client_status": "description"})
    rows = lookup_latest(rows, lake["tree_order_types"], "order_type_id", {"client_type": "description"})
    if type_needs_user:
        rows = rows.withColumn("client_type", F.when(F.col("tree_user_id").isNotNull(), F.col("client_type")))
    # last, so that no other join moves the nested items
    rows = lookup(rows, products, {"client": "client", "id": "order_id"}, {"products": "products", "part": "part", "parts": "parts"})
    rows = rows.withColumns({"part": F.coalesce("part", F.lit(0)), "parts": F.coalesce("parts", F.lit(1))})
    return rows.select(
        "client_partition_id", "client_partner_id", "client", "tree_user_id", "sponsor_id", "client_user_type",
        "client_type", "client_status", F.col("id").alias("order_id"), flag(F.col("autoship_template_id")).alias("is_autoship"),
        *ORDER_FIELDS, F.col("created_date").alias("created"), F.col("modified_date").alias("modified"),
        "client_order_id", "client_user_id", "event_id", "ingested_at", "products", "part", "parts",
    )


def staging_orders(lake: Lake, tenants: DataFrame, rules: Rules, first, last, **options) -> DataFrame:
    rows = order_rules(refined_orders(lake, tenants, first, last, **options), rules)
    return rows.drop("sponsor_id", "client_user_type")


ADDRESS = ["address1", "address2", "city", "postal_code", "state", "country"]
CONTACT_FIELDS = [
    "level_of_interest", "first_name", "last_name", "birthday", "created_at", "updated_at", "is_downline_contact", "opt_in",
    "info", "avatar_file_name", "avatar_content_type", "avatar_file_size", "avatar_updated_at",
]


def staging_contacts(
    lake: Lake, tenants: DataFrame, first, last, child_key: str = "contact_id", how: Mapping[str, str] | None = None,
    child_limit: int = CHILD_LIMIT,
) -> DataFrame:
    """Contacts changed in the window (themselves or a child), four arrays nested.

    ``child_key`` is the column of phones and category links that holds the
    contact. ``how`` sets the join per child; by default a contact without
    e-mail, phone or category is left out.
    """
    how = {"emails": "inner", "phone_numbers": "inner", "categories": "inner", **(how or {})}
    ids = cut(changed_ids(
        [
            (lake["pyr_contacts"], "id"),
            (lake["pyr_contact_emails"], "contact_id"),
            (lake["pyr_contact_phone_numbers"], child_key),
            (lake["pyr_contacts_contact_categories"], child_key),
        ],
        "contact_id", first, last,
    ), "ids")
    key = ["client", "contact_id"]
    contacts = _state(lake, "pyr_contacts", ids, "id", "contact_id")
    emails = _versions(lake, "pyr_contact_emails", ids, "contact_id", "contact_id")
    phones = _versions(lake, "pyr_contact_phone_numbers", ids, "contact_id", "contact_id")
    # the earliest event names a category; links without one do not take part in the ranking
    names = latest_by(lake["pyr_contact_categories"], ["client", "id"], earliest_event()).select(
        "client", F.col("id").alias("contact_category_id"), F.col("category_name").alias("category")
    )
    links = _versions(lake, "pyr_contacts_contact_categories", ids, "contact_id", "contact_id").join(names, ["client", "contact_category_id"])
    children = nest_many(
        {
            "emails": Child(
                cut(latest_by(emails, [*key, "email"]), "emails"),
                ["email", "preferred", "undeliverable_count", "spam_reported_count", "source"], ["id"],
            ),
            "phone_numbers": Child(
                cut(latest_by(phones, [*key, "unformatted_phone_number"]), "phones"),
                ["phone_number", "label", "unformatted_phone_number", "source", "dialing_code"], ["id"],
            ),
            # one link per contact is left
            "categories": Child(cut(latest_by(links, key), "categories"), ["category", "created_at", "updated_at"], ["id"]),
        },
        key, child_limit,
    )
    rows = with_tenant(contacts.withColumnRenamed("id", "contact_id"), tenants).join(children, key, "left")
    for name, kind in how.items():
        has = F.col(f"n_{name}") > 0
        rows = rows.filter(has) if kind == "inner" else rows.withColumn(name, F.when(has, F.col(name)))
    members = _referenced(lake, "tree_users", ["sponsor_id"], contacts, "tree_user_id")
    logins = _referenced(lake, "users", ["tree_user_id"], contacts, "user_id")
    rows = lookup(rows.withColumnRenamed("tree_user_id", "own_id"), members, {"client": "client", "own_id": "id"}, {"member": "id", "sponsor": "sponsor_id"})
    rows = lookup(rows.withColumnRenamed("user_id", "login_id"), logins, {"client": "client", "login_id": "id"}, {"login": "id", "login_user": "tree_user_id"})
    is_member = F.col("member").isNotNull()
    return rows.select(
        "client_partition_id", "client_partner_id", "client", F.col("contact_id").alias("id"),
        F.when(is_member, F.col("sponsor")).otherwise(F.col("login_user")).alias("owner_tree_user_id"),
        F.when(is_member, F.col("login")).otherwise(F.col("login_id")).alias("owner_user_id"),
        F.col("member").alias("tree_user_id"),
        F.when(is_member, F.col("login_id")).alias("user_id"),
        F.col("contact_type").alias("type"),
        *(F.col(c).alias("is_downline" if c == "is_downline_contact" else c) for c in CONTACT_FIELDS),
        "event_id", F.array(F.struct(*ADDRESS)).alias("addresses"), "emails", "phone_numbers", "categories",
        F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("parts", F.lit(1)).alias("parts"),
    )


def pii_users(lake: Lake, tenants: DataFrame, first, last) -> DataFrame:
    """Personal data of users ingested in ``(first, last]``, latest version of the window."""
    latest = latest_by(in_window(lake["tree_users"], first, last, lower_inclusive=False), ["client", "id"])
    return with_tenant(latest, tenants).select(
        "client_partition_id", "client_partner_id", "client", "event_id", F.current_timestamp().alias("ingested_at"),
        F.col("id").alias("tree_user_id"), "first_name", "last_name", "company_name",
        street(F.col("address1"), F.col("address2")).alias("street"), "city", "state", "country", "email", "phone",
        "mobile_phone", gender(F.col("gender")).alias("gender"), "birth_date", F.col("created_date").alias("created_at"),
    )
