"""Assembly of flat raw tables: messages, links, sites, tasks, back-fill, commissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import PLACEHOLDER
from tidemark.functions.clean import EPOCH_EVENT
from tidemark.functions.dates import complete_units
from tidemark.functions.rules import flag, gender, street
from tidemark.operators.joins import attach_tenant, join_on_number, keep_all, lookup, polymorphic_lookup, with_tenant
from tidemark.operators.nesting import CHILD_LIMIT, Child, nest_children, nest_many
from tidemark.plans.refine import ITEM_SHIPPING, ORDER_FIELDS, PRODUCT_FIELDS
from tidemark.plans.rules import coded_order_type, coded_owner

# Kinds a polymorphic reference may name. Fixed values.
KIND_USER = "User"
KIND_CONTACT = "PyrCrm::Contact"
KIND_TREE_USER = "PyrTree::User"
KIND_ASSET = "PyrCore::ResourceAsset"

# Message and recipient columns and their names after assembly. Fixed values.
MESSAGE_COLUMNS = {
    "sender_id": "sender_id", "sender_type": "sender_type", "sent_date": "sent_date", "to": "message_to", "from": "from",
    "subject": "subject", "message": "message", "short_message": "short_message", "draft": "draft",
    "delivery_status": "delivery_status", "reply_to_id": "reply_to_id", "forwarded_from_id": "forwarded_from_id",
    "internal_recipient_count": "internal_recipient_count", "internal_open_count": "internal_open_count", "size": "size",
    "has_attachments": "has_attachments", "extras": "message_extras", "created_at": "message_created_at",
    "updated_at": "message_updated_at", "message_type": "message_type", "system_generated": "system_generated",
    "tag_deleted": "message_tag_deleted", "tag_trash": "message_tag_trash", "tag_important": "message_tag_important",
    "tag_starred": "message_tag_starred", "cc": "message_cc", "bcc": "message_bcc",
    "undeliverable_count": "undeliverable_count", "spam_reported_count": "spam_reported_count", "tag_spam": "tag_spam",
}
RECIPIENT_COLUMNS = {
    "recipient_id": "recipient_id", "recipient_type": "recipient_type", "consultant_id": "consultant_id",
    "delivery_type": "delivery_type", "to": "recipient_to", "subject_interpolated": "subject_interpolated",
    "message_interpolated": "message_interpolated", "opened_count": "opened_count", "tag_starred": "recipient_tag_starred",
    "tag_important": "recipient_tag_important", "tag_spam": "recipient_tag_spam", "tag_trash": "recipient_tag_trash",
    "tag_deleted": "recipient_tag_deleted", "from_pyr_user": "from_pyr_user", "from_community": "from_community",
    "from_downline": "from_downline", "from_upline": "from_upline", "from_team": "from_team",
    "replied_to_message_id": "replied_to_message_id", "forwarded_message_id": "forwarded_message_id",
    "message_header_id": "message_header_id", "extras": "recipient_extras", "created_at": "recipient_created_at",
    "updated_at": "recipient_updated_at", "read": "read", "from_contact": "from_contact", "seen": "seen",
    "undeliverable": "undeliverable", "cc": "recipient_cc", "bcc": "recipient_bcc", "spam_reported": "spam_reported",
}


def _renamed(df: DataFrame, columns: dict[str, str]) -> list[Column]:
    return [
        (F.col(f"`{old}`") if old in df.columns else F.lit(None).cast("string")).alias(new) for old, new in columns.items()
    ]


def _senders(messages: DataFrame, users: DataFrame, contacts: DataFrame) -> DataFrame:
    return polymorphic_lookup(
        messages, "sender_type", "sender_id",
        {KIND_CONTACT: (contacts, "id", "tree_user_id"), KIND_USER: (users, "id", "tree_user_id")},
        "sender_tree_user_id",
    )


def _recipients(recipients: DataFrame, users: DataFrame, contacts: DataFrame, tree_users: DataFrame) -> DataFrame:
    return polymorphic_lookup(
        recipients.filter("delivery_type = 'email'"), "recipient_type", "recipient_id",
        {
            KIND_TREE_USER: (tree_users, "id", "id"),
            KIND_CONTACT: (contacts, "id", "tree_user_id"),
            KIND_USER: (users, "id", "tree_user_id"),
        },
        "recipient_tree_user_id",
    )


def staging_emails(
    messages: DataFrame, recipients: DataFrame, users: DataFrame, contacts: DataFrame, tree_users: DataFrame,
    tenants: DataFrame, tenant: str, child_limit: int = CHILD_LIMIT,
) -> DataFrame:
    """Messages of a tenant with the sender resolved and e-mail recipients nested.

    A message without recipients holds one record of NULLs, as the left join it
    stands for would give.
    """
    to = _recipients(recipients, users, contacts, tree_users)
    fields = [F.col("recipient_tree_user_id"), *_renamed(to, RECIPIENT_COLUMNS)]
    nested = nest_children(to, ["message_id"], fields, "recipients", child_limit, ids=["recipient_type", "recipient_id"])
    rows = _senders(messages, users, contacts)
    rows = rows.select("sender_tree_user_id", F.col("id").alias("message_id"), *_renamed(rows, MESSAGE_COLUMNS))
    rows = rows.join(nested, "message_id", "left")
    record = nested.schema["recipients"].dataType.elementType
    nobody = F.array(F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in record.fields)))
    return attach_tenant(
        rows.withColumns({
            "recipients": F.coalesce("recipients", nobody), "part": F.coalesce("part", F.lit(0)), "parts": F.coalesce("parts", F.lit(1)),
        }),
        tenants, tenant,
    )


def flat_emails(messages: DataFrame, recipients: DataFrame, users: DataFrame, contacts: DataFrame, tree_users: DataFrame) -> DataFrame:
    """One row per message and e-mail recipient."""
    to = _recipients(recipients, users, contacts, tree_users)
    to = to.select("message_id", "recipient_tree_user_id", *_renamed(to, RECIPIENT_COLUMNS))
    rows = _senders(messages, users, contacts)
    rows = rows.select(
        F.col("sender_tree_user_id").alias("message_tree_user_id"), F.col("id").alias("message_id"), *_renamed(rows, MESSAGE_COLUMNS)
    )
    return keep_all(rows, to, "message_id")


RESOURCE = {"id": "resource_id", "title": "title", "created_at": "created", "updated_at": "resource_updated", "expiry_date": "resource_expires"}
ASSET_TEXT = ["title", "file_type", "file_name", "file_description"]
ASSET_COUNTS = ["likes_count", "shares_count", "abuse_reports_count", "views_count", "downloads_count"]


def staging_links(links: DataFrame, assets: DataFrame, resources: DataFrame, users: DataFrame) -> DataFrame:
    """Shared links of a tenant's users with the shared asset and its resource nested.

    Links to anything but an asset keep NULLs in the nested record.
    """
    resource = resources.select("id", F.struct(*(F.col(c).alias(n) for c, n in RESOURCE.items())).alias("_resource"))
    described = lookup(assets, resource, {"resource_id": "id"}, {"_resource": "_resource"})
    record = F.struct(
        F.col("_resource").alias("resource"),
        *ASSET_TEXT,
        F.col("available_email").try_cast("boolean").alias("can_email"),
        F.col("allow_download").try_cast("boolean").alias("allow_download"),
        *ASSET_COUNTS,
        F.col("created_at").alias("created"),
        F.col("updated_at").alias("updated"),
    )
    asset = described.select(F.col("id").alias("_asset"), record.alias("resource_asset"))
    on = (F.col("asset_type") == KIND_ASSET) & (F.col("asset_id") == F.col("_asset"))
    sharers = users.select(F.col("user_id").alias("_sharer"))
    return (
        links.join(sharers, F.col("user_id") == F.col("_sharer"), "left_semi")
        .join(asset, on, "left")
        .select(
            F.col("id").alias("link_id"), F.col("user_id").alias("link_sharer_id"), "created_at", "asset_id", "asset_type",
            "resource_asset", "containable_id", "containable_type", "channel_id", "channel_type",
        )
    )


def site_visitors(sites: DataFrame, visitors: DataFrame, users: DataFrame, tracking: DataFrame, tenant: str | None = None) -> DataFrame:
    """Flat visits: sites without visitors stay, sites of unknown users go."""
    owners = users.select(F.col("id").alias("user_id"), "tree_user_id")
    owned = join_on_number(sites.select(F.col("id").alias("site_id"), F.col("user_id").alias("_owner")), owners, "_owner", "user_id").drop("_owner")
    visits = visitors.select("site_id", "visitor_id", "last_visit_date", "visit_count", "ipaddress", "browser_agent", "created_at")
    codes = tracking.select("user_id", "third_party_tracking_company", "tracking_code")
    rows = keep_all(owned, visits, "site_id").join(codes, "user_id", "left")
    return rows if tenant is None else rows.withColumn("client", F.lit(tenant))


def staging_sites(
    sites: DataFrame, visitors: DataFrame, users: DataFrame, tracking: DataFrame, tenants: DataFrame, tenant: str, child_limit: int = CHILD_LIMIT,
) -> DataFrame:
    """Sites of known users with their visitors and tracking codes nested; a site without either keeps NULLs there."""
    owners = users.select(F.col("id").alias("user_id"), "tree_user_id")
    owned = join_on_number(sites.select(F.col("id").alias("site_id"), F.col("user_id").alias("_owner"), "created_at"), owners, "_owner", "user_id").drop("_owner")
    codes = owned.select("site_id", "user_id").join(tracking.select("user_id", "third_party_tracking_company", "tracking_code"), "user_id")
    visit = ["visitor_id", "last_visit_date", "visit_count", "ipaddress", "browser_agent", F.col("created_at").alias("created")]
    children = nest_many(
        {
            "analytics_tracking_codes": Child(codes, ["third_party_tracking_company", "tracking_code"], ["tracking_code"]),
            "visitors": Child(visitors, visit, ["visitor_id"]),
        },
        ["site_id"], child_limit,
    )
    rows = owned.join(children, "site_id", "left")
    return attach_tenant(rows.withColumns({"part": F.coalesce("part", F.lit(0)), "parts": F.coalesce("parts", F.lit(1))}), tenants, tenant)


def tasks(raw: DataFrame, users: DataFrame, any_case: bool = True) -> DataFrame:
    """Tasks but tests; those without a title go too. ``any_case``: 'Test' counts as well."""
    title = F.col("task_title")
    kept = raw.filter(~(title.ilike("%test%") if any_case else title.like("%test%")))
    return kept.join(users.select(F.col("id").alias("user_id"), "tree_user_id"), "user_id").select(
        "id", "task_title", "description", "due_date", "user_id", "tree_user_id",
        F.when(F.col("source") == "system", 1).otherwise(0).alias("from_system"), "priority", "created_at", "completed_at",
    )


# ---- one-off back-fill of a tenant's raw copy -------------------------------------


def backfill_users(tree_users: DataFrame, users: DataFrame, types: DataFrame, statuses: DataFrame, tenants: DataFrame, tenant: str) -> DataFrame:
    """Raw users as conformed rows whose type and status still hold the placeholder."""
    rows = lookup(tree_users, users, {"id": "tree_user_id"}, {"user_id": "id"})
    rows = lookup(rows, types, {"user_type_id": "id"}, {"client_type": "description"}, "inner")
    rows = lookup(rows, statuses, {"user_status_id": "id"}, {"client_status": "description"}, "inner")
    return attach_tenant(rows, tenants, tenant).select(
        "client_partition_id", "client_partner_id", "client", F.lit(EPOCH_EVENT).alias("event_id"),
        F.current_timestamp().alias("ingested_at"), F.col("id").alias("tree_user_id"), "user_id", "sponsor_id", "parent_id",
        F.lit(PLACEHOLDER).alias("type"), F.lit(PLACEHOLDER).alias("status"), "client_type", "zip",
        F.col("coded_date").alias("coded"), F.col("created_date").alias("created"), "client_status", F.col("updated_date").alias("modified"),
    )


def backfill_orders(
    orders: DataFrame, items: DataFrame, types: DataFrame, statuses: DataFrame, users: DataFrame, tenants: DataFrame, tenant: str,
    child_limit: int = CHILD_LIMIT,
) -> DataFrame:
    """Raw orders with items nested; owner and type by the buyer's type and coding date."""
    fields = [*PRODUCT_FIELDS, *(F.col(c).alias(f"item_{c}") for c in ITEM_SHIPPING)]
    products = nest_children(items, ["order_id"], fields, "products", child_limit, ids=["id"])
    rows = with_tenant(users.filter(F.lower("client") == tenant.lower()).select("client", "tree_user_id", "sponsor_id", "coded", F.col("type").alias("user_type")), tenants)
    rows = orders.drop("client").join(rows, "tree_user_id")
    rows = lookup(rows, types, {"order_type_id": "id"}, {"client_type": "description"}, "inner")
    rows = lookup(rows, statuses, {"order_status_id": "id"}, {"client_status": "description"}, "inner")
    rows = lookup(rows, products, {"id": "order_id"}, {"products": "products", "part": "part"})
    buyer = (F.col("user_type"), F.col("coded"), F.col("order_date"))
    return rows.select(
        "client", "client_partition_id", "client_partner_id", F.lit(EPOCH_EVENT).alias("event_id"), F.current_timestamp().alias("ingested_at"),
        F.col("id").alias("order_id"), coded_owner(*buyer, F.col("tree_user_id"), F.col("sponsor_id")).alias("commission_user_id"),
        "tree_user_id", coded_order_type(*buyer).alias("type"), F.lit(PLACEHOLDER).alias("status"), "client_type", "client_status",
        flag(F.col("autoship_template_id")).alias("is_autoship"), *ORDER_FIELDS, F.col("created_date").alias("created"),
        F.col("modified_date").alias("modified"), "client_order_id", "client_user_id", "products", F.coalesce("part", F.lit(0)).alias("part"),
    )


def backfill_pii(tree_users: DataFrame, tenants: DataFrame, tenant: str) -> DataFrame:
    return attach_tenant(tree_users, tenants, tenant).select(
        "client_partition_id", "client_partner_id", "client", F.lit(EPOCH_EVENT).alias("event_id"), F.current_timestamp().alias("ingested_at"),
        F.col("id").alias("tree_user_id"), "first_name", "last_name", "company_name",
        street(F.col("address1"), F.col("address2")).alias("street"), "city", "state", "country", "email", "phone", "mobile_phone",
        gender(F.col("gender")).alias("gender"), "birth_date",
    )


# ---- flat report tables -----------------------------------------------------------


def commissions(users: DataFrame, earned: DataFrame, runs: DataFrame, periods: DataFrame, period_types: DataFrame) -> DataFrame:
    """Earnings per user and commission run with the run's period."""
    rows = earned.join(users.select("tree_user_id"), "tree_user_id", "left_semi")
    rows = lookup(rows, runs, {"commission_run_id": "id"}, {"run_date": "run_date", "period_id": "period_id"}, "inner")
    rows = lookup(rows, periods, {"period_id": "id"}, {"period_type_id": "period_type_id", "period": "description"}, "inner")
    rows = lookup(rows, period_types, {"period_type_id": "id"}, {"period_type": "description"}, "inner")
    return rows.select(
        "tree_user_id", F.col("commission_run_id").alias("run_id"), "run_date", "period_id", "period_type_id", "period", "period_type",
        "currency_code", "earnings",
    )


COMMISSION_KEY = ["tree_user_id", "run_id", "period_id"]


def nested_commissions(flat: DataFrame, child_limit: int = CHILD_LIMIT) -> DataFrame:
    """One row per user with the runs and earnings nested."""
    return nest_children(
        flat, ["tree_user_id"], ["run_date", "run_id", "period", "period_type", "currency_code", "earnings"], "runs", child_limit, ids=["run_id"]
    )


def order_items_flat(orders: DataFrame, items: DataFrame, types: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row per order item with the order's columns."""
    shipping = [c for c in ITEM_SHIPPING if c != "tracking_number"]
    # the item's side of the join is the larger one, and AQE can split it
    lines = items.select(
        "order_id", F.col("id").alias("order_item_id"), *PRODUCT_FIELDS, *(F.col(c).alias(f"item_{c}") for c in ITEM_SHIPPING)
    )
    heads = lookup(orders, types, {"order_type_id": "id"}, {"type": "description"}, "inner")
    heads = lookup(heads, statuses, {"order_status_id": "id"}, {"status": "description"}, "inner")
    heads = heads.select(
        F.col("id").alias("order_id"), "tree_user_id", "type", "status", flag(F.col("autoship_template_id")).cast("int").alias("is_autoship"),
        *(F.col(c).alias(f"order_{c}" if c in shipping or c == "tracking_number" else c) for c in ORDER_FIELDS),
        "created_date", "modified_date", "client_order_id", "client_user_id",
    )
    return lines.join(heads, "order_id")


def demographics(tree_users: DataFrame, users: DataFrame, types: DataFrame, statuses: DataFrame, as_of) -> DataFrame:
    """Users with place, gender and age in complete years at ``as_of``."""
    rows = lookup(tree_users, users, {"id": "tree_user_id"}, {"user_id": "id"})
    rows = lookup(rows, types, {"user_type_id": "id"}, {"type": "description"}, "inner")
    rows = lookup(rows, statuses, {"user_status_id": "id"}, {"status": "description"}, "inner")
    moment = F.lit(as_of).cast("timestamp_ntz")
    return rows.select(
        F.col("id").alias("tree_user_id"), "user_id", "sponsor_id", "parent_id", "type", "city", "state", "zip", "country", "gender",
        complete_units("YEAR", F.col("birth_date").cast("timestamp_ntz"), moment).alias("age"),
        F.col("created_date").alias("signup_date"), "status", F.col("updated_date").alias("last_modified"),
    )


PRODUCT_COLUMNS = ["name", "description", "short_description", "available_on", "discontinue_on", "slug", "avg_rating", "reviews_count"]
REVIEW_COLUMNS = ["location", "rating", "title", "review", "approved", "created_at", "updated_at", "user_id", "ip_address", "locale", "show_identifier"]


def product_reviews(reviews: DataFrame, users: DataFrame, products: DataFrame, variants: DataFrame) -> DataFrame:
    """Reviews with product and reviewer, one row per variant of the product."""
    rows = reviews.join(users.select(F.col("id").alias("user_id"), "tree_user_id"), "user_id")
    side = products.select(F.col("id").alias("product_id"), *(F.col(c).alias(f"product_{c}") for c in PRODUCT_COLUMNS))
    codes = variants.select("product_id", F.col("sku").alias("product_code"))
    return rows.join(side, "product_id").join(codes, "product_id").select(
        "product_code", *(f"product_{c}" for c in PRODUCT_COLUMNS), F.col("name").alias("review_name"), *REVIEW_COLUMNS, "tree_user_id"
    )
