"""Configuration as data: tenants, tenant rules, file routes, export tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import local_table

# Tables are partitioned by the tenant's number, which the schema limits to this
# range; so the tenant dimension never has more rows. Fixed value.
MAX_TENANTS = 100

TENANT_SCHEMA = T.StructType(
    [
        T.StructField("client", T.StringType(), False),
        T.StructField("partition_id", T.LongType(), False),
        T.StructField("partner_id", T.StringType(), False),
    ]
)


def tenants(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """The tenant dimension as a local relation."""
    if len(rows) > MAX_TENANTS:
        raise ValueError(f"{len(rows)} tenants, partition numbers end at {MAX_TENANTS}")
    return local_table(spark, rows, TENANT_SCHEMA)


# Client user types that decide the conformed type, in lower case. Fixed values.
USER_TYPES = {
    "employee": "Autoship",
    "rcscompany": "Autoship",
    "b2b": "Distributor",
    "import": "Distributor",
    "distributor": "Distributor",
    "freemium": "Distributor",
    "uk-trial": "Distributor",
}
# Substrings that decide before the table above, in this order. Fixed values.
USER_TYPE_CONTAINS = [("transfer", "Distributor"), ("customer", "Autoship")]
# A client type that repeats the tenant's own name. Fixed value.
OWN_NAME_TYPE = "Autoship"
# Client statuses that stay active; every other one is inactive. Fixed values.
ACTIVE_USER_STATUSES = ["active", "grace", "hold"]
# Client order statuses that are inactive; every other one is active. Fixed values.
INACTIVE_ORDER_STATUSES = ["ach declined", "cancelled", "cc declined"]

# One-off updates of rows loaded with the placeholder. Fixed values.
PLACEHOLDER = "tbd"
BACKFILL_AUTOSHIP_TYPES = ["Employee", "RCSCompany"]
BACKFILL_DISTRIBUTOR_TYPES = ["B2B", "Import", "Distributor"]
BACKFILL_ACTIVE_STATUSES = ["Active", "Grace", "Hold"]
BACKFILL_INACTIVE_ORDER_STATUSES = ["ACH Declined", "Cancelled", "CC Declined"]
# Second tenant's user types. Fixed values.
MEMBER_TYPES = {"MEMBER": "Distributor", "RETAIL": "Customer", "BA": "Distributor", "PC": "Autoship"}
# Order codes and their types. Fixed values.
ORDER_CODES = {
    "B": "Backorder Cancelled",
    "C": "Credit/RMA",
    "D": "Retail",
    "E": "Exchange/RMA",
    "I": "Wholesale",
    "R": "Replacement",
    "X": "Exchange/Order",
    "Y": "Point Redemption",
}


@dataclass(frozen=True)
class TenantRules:
    """How one tenant's client types and statuses become conformed ones.

    ``normalize``: rule tables above. Otherwise ``user_type``/``order_type`` and
    the statuses are constants, or (None) the client's own value is passed on.
    """

    normalize: bool = False
    user_type: str | None = None
    user_status: str | None = None
    order_type: str | None = None
    order_status: str | None = None


@dataclass(frozen=True)
class Rules:
    """Rules per tenant (lower case); rows of tenants without rules are dropped."""

    by_tenant: Mapping[str, TenantRules] = field(default_factory=dict)


NORMALIZED = TenantRules(normalize=True)
# Users keep the client's type; orders are all active customer orders of the buyer.
PASS_THROUGH = TenantRules(order_type="Customer", order_status="Active")


# Name parts of the change files and the lake table each belongs to. Fixed values.
CHANGE_FILES = {
    "messages": "pyr_messages",
    "message-recipients": "pyr_message_recipients",
    "orders": "tree_orders",
    "order-items": "tree_order_items",
    "sites": "pyr_sites",
    "site-visitors": "pyr_site_visitors",
    "site-analytics": "pyr_sites_analytics_tracking_codes",
    "tasks": "pyr_user_tasks",
    "users": "users",
    "contacts": "pyr_contacts",
    "ecards": "pyr_ecards",
    "events": "pyr_events",
    "microsites": "pyr_microsites",
    "resource-assets": "pyr_resource_assets",
    "resources": "pyr_resources",
    "sms": "pyr_sms",
    "tree-users": "tree_users",
    "tree-user-types": "tree_user_types",
    "tree-order-types": "tree_order_types",
    "tree-order-statuses": "tree_order_statuses",
    "commission-bonuses": "tree_commission_bonuses",
    "tree-commission-details": "tree_commission_details",
    "tree-commission-runs": "tree_commission_runs",
    "tree-commissions": "tree_commissions",
    "contact-emails": "pyr_contact_emails",
    "contact-phone-numbers": "pyr_contact_phone_numbers",
    "contacts-contact-categories": "pyr_contacts_contact_categories",
    "contact-categories": "pyr_contact_categories",
    "tree-user-statuses": "tree_user_statuses",
    "rank-definitions": "pyr_rank_definitions",
    "login-histories": "pyr_login_histories",
}


def routes(stream: str, suffix: str = "final") -> dict[str, str]:
    """File name prefix -> lake table, for the stream a deployment writes under."""
    return {f"{stream}-{part}-{suffix}": table for part, table in CHANGE_FILES.items()}


# Exported tables and the column a creation-date filter reads: the name our own schema has for it.
EXPORT_TABLES = {
    "pii.users": "created_at",
    "staging.emails": "created",
    "staging.flat_site_visitors": "created_at",
    "staging.orders": "created",
    "staging.product_reviews": "created_at",
    "staging.sites": "created_at",
    "staging.tasks": "created",
    "staging.users": "created",
    "staging.contacts": "created_at",
}

# Relational tables of the initial load; the key is ``id`` unless named. Fixed values.
RELATIONAL_TABLES = [
    "pyr_contact_categories",
    "pyr_contact_emails",
    "pyr_contact_phone_numbers",
    "pyr_contacts",
    "pyr_contacts_contact_categories",
    "pyr_ecards",
    "pyr_events",
    "pyr_message_recipients",
    "pyr_messages",
    "pyr_microsites",
    "pyr_rank_definitions",
    "pyr_resource_assets",
    "pyr_resources",
    "pyr_sites",
    "pyr_sms",
    "pyr_user_tasks",
    "tree_commission_bonuses",
    "tree_commission_details",
    "tree_commission_runs",
    "tree_commissions",
    "tree_order_items",
    "tree_order_statuses",
    "tree_order_types",
    "tree_orders",
    "tree_user_statuses",
    "tree_user_types",
    "tree_users",
    "users",
    "tree_bonuses",
    "pyr_login_histories",
]
OTHER_KEYS = {"tree_commissions": "tree_user_id"}


def key_field(table: str) -> str:
    return OTHER_KEYS.get(table, "id")
