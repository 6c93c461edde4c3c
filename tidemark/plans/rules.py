"""Tenant rules applied to refined users and orders in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.config import Rules, TenantRules
from tidemark.functions.rules import first_match, map_values
from tidemark.operators.changes import update_from, update_where


def normalized_user_type(raw: Column, tenant: Column) -> Column:
    """Conformed type of a client user type; NULL for an unknown one."""
    low = F.lower(raw)
    cases = [(low.contains(part), F.lit(label)) for part, label in config.USER_TYPE_CONTAINS]
    cases.append((low == F.lower(tenant), F.lit(config.OWN_NAME_TYPE)))
    return first_match(cases, map_values(low, config.USER_TYPES))


def required_user_type(raw: Column, tenant: Column) -> Column:
    """As above, but an unknown type stops the job."""
    found = normalized_user_type(raw, tenant)
    message = F.concat(F.lit("client type `"), F.lower(raw), F.lit("` not found in list"))
    return F.when(found.isNotNull() | raw.isNull(), found).otherwise(F.raise_error(message))


def normalized_user_status(raw: Column) -> Column:
    return F.when(
        raw.isNotNull(), F.when(F.lower(raw).isin(*config.ACTIVE_USER_STATUSES), "Active").otherwise("Inactive")
    )


def normalized_order_status(raw: Column) -> Column:
    return F.when(
        raw.isNotNull(), F.when(F.lower(raw).isin(*config.INACTIVE_ORDER_STATUSES), "Inactive").otherwise("Active")
    )


def order_type(user_type: Column, created: Column, order_date: Column) -> Column:
    """A distributor's order is wholesale once the order was due, before that autoship."""
    low = F.lower(user_type)
    return (
        F.when((low == "distributor") & (created <= order_date), "Wholesale")
        .when((low == "distributor") & (created > order_date), "Autoship")
        .when(low == "autoship", "Autoship")
        .otherwise(user_type)
    )


def commission_owner(kind: Column, tree_user_id: Column, sponsor_id: Column) -> Column:
    """A distributor earns on the own order, for everyone else the sponsor does."""
    return F.when(F.lower(kind) == "distributor", tree_user_id).otherwise(sponsor_id)


def _each_tenant(rules: Rules, value) -> Column:
    """``value(tenant_rules)`` for the row's tenant."""
    tenant = F.lower("client")
    return first_match([(tenant == name, value(rule)) for name, rule in rules.by_tenant.items()])


def _known(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(F.lower("client").isin(*rules.by_tenant)) if rules.by_tenant else df.limit(0)


def _empty_type(rules: Rules, raw: Column) -> Column:
    normalized = [t for t, r in rules.by_tenant.items() if r.normalize]
    return F.lower("client").isin(*normalized) & (raw.isNull() | (raw == ""))


def user_rules(df: DataFrame, rules: Rules, in_name: str = "client_type", out_name: str = "type") -> DataFrame:
    """Add ``type`` and ``status``; normalised tenants lose rows without a client type."""
    raw, tenant = F.col(in_name), F.col("client")

    def kind(rule: TenantRules) -> Column:
        if rule.normalize:
            return required_user_type(raw, tenant)
        return raw if rule.user_type is None else F.lit(rule.user_type)

    def status(rule: TenantRules) -> Column:
        if rule.normalize:
            return normalized_user_status(F.col("client_status"))
        return F.lit(rule.user_status).cast("string")

    kept = _known(df, rules).filter(~_empty_type(rules, raw))
    return kept.withColumns({out_name: _each_tenant(rules, kind), "status": _each_tenant(rules, status)})


def order_rules(df: DataFrame, rules: Rules, owner_by: str = "type") -> DataFrame:
    """Add ``type``, ``status`` and ``commission_user_id`` to refined orders.

    ``owner_by="type"`` reads the order type written just before, as the chained
    transforms did, so the sponsor owns every order of a normalised tenant;
    ``owner_by="user_type"`` reads the buyer's type instead.
    """
    raw, tenant = F.col("client_user_type"), F.col("client")

    def user_kind(rule: TenantRules) -> Column:
        return required_user_type(raw, tenant) if rule.normalize else F.lit(None).cast("string")

    typed = _known(df, rules).filter(~_empty_type(rules, raw)).withColumn("_user_type", _each_tenant(rules, user_kind))

    def kind(rule: TenantRules) -> Column:
        if rule.normalize:
            return order_type(F.col("_user_type"), F.col("created"), F.col("order_date"))
        return F.lit(rule.order_type) if rule.order_type else F.col("client_type")

    def status(rule: TenantRules) -> Column:
        return normalized_order_status(F.col("client_status")) if rule.normalize else F.lit(rule.order_status).cast("string")

    typed = typed.withColumns({"type": _each_tenant(rules, kind), "status": _each_tenant(rules, status)})
    seen = F.col("type") if owner_by == "type" else F.col("_user_type")

    def owner(rule: TenantRules) -> Column:
        if rule.normalize:
            return commission_owner(seen, F.col("tree_user_id"), F.col("sponsor_id"))
        return F.col("tree_user_id")

    return typed.withColumn("commission_user_id", _each_tenant(rules, owner)).drop("_user_type")


# ---- one-off updates of back-filled rows ---------------------------------------


def update_user_types(users: DataFrame, tenant: str) -> DataFrame:
    """Type and status of the rows still holding the placeholder (first rule set)."""
    raw = F.col("client_type")
    kind = (
        F.when(raw.like("%Customer%") | raw.isin(*config.BACKFILL_AUTOSHIP_TYPES), "Autoship")
        .when(raw.isin(*config.BACKFILL_DISTRIBUTOR_TYPES) | raw.like("%Transfer%"), "Distributor")
    )
    status = F.when(F.col("client_status").isin(*config.BACKFILL_ACTIVE_STATUSES), "Active").otherwise("Inactive")
    return _update_placeholders(users, tenant, kind, status)


def update_member_types(users: DataFrame, tenant: str) -> DataFrame:
    """The same by the second tenant's codes; its statuses are passed on."""
    return _update_placeholders(users, tenant, map_values(F.col("client_type"), config.MEMBER_TYPES), F.col("client_status"))


def _update_placeholders(users: DataFrame, tenant: str, kind: Column, status: Column) -> DataFrame:
    mine = F.lower("client") == tenant.lower()
    typed = update_where(users, mine & (F.col("type") == config.PLACEHOLDER), {"type": kind})
    return update_where(typed, mine & (F.col("status") == config.PLACEHOLDER), {"status": status})


def order_code_type(code: Column) -> Column:
    return map_values(code, config.ORDER_CODES)


def update_order_status(orders: DataFrame, tenant: str) -> DataFrame:
    status = F.when(F.col("client_status").isin(*config.BACKFILL_INACTIVE_ORDER_STATUSES), "Inactive").otherwise("Active")
    return update_where(orders, F.lower("client") == tenant.lower(), {"status": status})


def coded_order_type(user_type: Column, coded: Column, order_date: Column) -> Column:
    """Order type from the buyer's type and coding date."""
    return (
        F.when((user_type == "Distributor") & (coded <= order_date), "Wholesale")
        .when((user_type == "Distributor") & (coded > order_date), "Autoship")
        .when(user_type == "Customer", "Retail")
        .when(user_type == "Autoship", "Autoship")
    )


def coded_owner(user_type: Column, coded: Column, order_date: Column, tree_user_id: Column, sponsor_id: Column) -> Column:
    """The sponsor owns orders of non-distributors and those placed before coding."""
    return (
        F.when(user_type != "Distributor", sponsor_id)
        .when((user_type == "Distributor") & (coded > order_date), sponsor_id)
        .when(user_type == "Distributor", tree_user_id)
    )


def update_orders_from_users(orders: DataFrame, users: DataFrame, tenant: str) -> DataFrame:
    """Owner and type of a tenant's orders from their buyers."""
    mine = F.lower("client") == tenant.lower()
    buyer = [F.col(f"src_{c}") for c in ("type", "coded")]
    return update_from(
        orders,
        users.filter(mine),
        {"client": "client", "tree_user_id": "tree_user_id"},
        ["type", "coded", "tree_user_id", "sponsor_id"],
        {
            "commission_user_id": coded_owner(*buyer, F.col("order_date"), F.col("src_tree_user_id"), F.col("src_sponsor_id")),
            "type": coded_order_type(*buyer, F.col("order_date")),
        },
    )
