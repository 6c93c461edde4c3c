"""Engagement features: sent messages, logins, and the joined feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.functions.rules import PLATFORM_FAMILIES, platform_is
from tidemark.operators.aggregates import count_if
from tidemark.plans.cohort import signups, user_order_features
from tidemark.session import cut

FIRST_ORDERS = ("retail", "wholesale", "autoship")
MESSAGE_KEY = ["sender_tree_user_id", "message_id", "created", "sent"]


def message_summary(messages: DataFrame) -> DataFrame:
    """Distinct recipients, and those who saw, read or never got it, per message.

    A message kept in one row is summed up inside its array, without a shuffle.
    Messages spread over several rows (see ``nest_children``) are grouped per
    recipient first, so one huge mailing is spread over all tasks.
    """
    many = F.col("parts") > 1 if "parts" in messages.columns else F.lit(False)

    def distinct(condition=None) -> Column:
        hit = F.col("recipients") if condition is None else F.filter("recipients", condition)
        ids = F.transform(hit, lambda r: r["recipient_tree_user_id"])
        return F.size(F.array_distinct(F.array_compact(ids))).cast("long")

    def earliest(field: str) -> Column:
        return F.array_min(F.transform("recipients", lambda r: r[field]))

    one = messages.filter(~many & (F.size("recipients") > 0)).select(
        *MESSAGE_KEY,
        distinct().alias("recipients_cnt"),
        earliest("seen").alias("min_seen"),
        distinct(lambda r: r["seen"].isNotNull()).alias("seen_cnt"),
        earliest("read").alias("min_read"),
        distinct(lambda r: r["read"].isNotNull()).alias("read_cnt"),
        distinct(lambda r: r["undeliverable"].isNotNull()).alias("undeliverable_cnt"),
    )
    if "parts" not in messages.columns:
        return one
    each = messages.filter(many).select(*MESSAGE_KEY, F.inline("recipients"))
    per_recipient = each.groupBy(*MESSAGE_KEY, "recipient_tree_user_id").agg(
        F.min("seen").alias("seen"), F.min("read").alias("read"), F.min("undeliverable").alias("undeliverable")
    )
    who = F.col("recipient_tree_user_id")
    spread = per_recipient.groupBy(*MESSAGE_KEY).agg(
        F.count(who).alias("recipients_cnt"),
        F.min("seen").alias("min_seen"),
        count_if(F.col("seen").isNotNull(), who).alias("seen_cnt"),
        F.min("read").alias("min_read"),
        count_if(F.col("read").isNotNull(), who).alias("read_cnt"),
        count_if(F.col("undeliverable").isNotNull(), who).alias("undeliverable_cnt"),
    )
    return one.unionByName(spread)


def _first_order_dates(features: DataFrame) -> DataFrame:
    return features.select(
        F.col("commission_user_id").alias("tree_user_id"),
        *(F.col(f"first_{k}.order_date").alias(f"first_{k}") for k in FIRST_ORDERS),
    )


def engagement(users: DataFrame, messages: DataFrame, features: DataFrame, user_type: str = "Distributor", client: str | None = None) -> DataFrame:
    """Messages created, sent, seen and read per sender: first 30 days and before each first order."""
    senders = (
        signups(users, user_type=user_type, client=client)
        .select(F.col("commission_user_id").alias("tree_user_id"), "signup")
        .join(_first_order_dates(features), "tree_user_id", "left")
        .withColumnRenamed("tree_user_id", "sender_tree_user_id")
    )
    rows = message_summary(messages).join(senders, "sender_tree_user_id").filter(F.to_date("created") >= F.col("signup"))
    early = days_between(F.col("created"), F.col("signup")).between(0, 30)

    def before(moment: str, kind: str) -> Column:
        return (F.to_date(moment) >= F.col("signup")) & (F.col(moment) <= F.col(f"first_{kind}"))

    def added(condition: Column, value: str) -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0))

    out = [
        days_between(F.min(F.to_date(moment)), F.col("signup")).alias(f"days_to_first_{name}")
        for name, moment in (("created", "created"), ("sent", "sent"), ("seen", "min_seen"), ("read", "min_read"))
    ]
    for name in ("created", "sent"):
        # both early counts go by the creation date
        out.append(count_if(early, F.col("message_id")).alias(f"cnt_{name}_first30"))
        out += [count_if(before(name, k), F.col("message_id")).alias(f"cnt_{name}_before_first_{k}") for k in FIRST_ORDERS]
    for name, moment in (("seen", "min_seen"), ("read", "min_read"), ("undeliverable", "sent")):
        out.append(added(early, f"{name}_cnt").alias(f"cnt_{name}_first30"))
        out += [added(before(moment, k), f"{name}_cnt").alias(f"cnt_{name}_before_first_{k}") for k in FIRST_ORDERS]
    return rows.groupBy("sender_tree_user_id", "signup").agg(*out).drop("signup")


def login_counts(users: DataFrame, logins: DataFrame, features: DataFrame, user_type: str = "Distributor", client: str | None = None) -> DataFrame:
    """Logins per user and platform: first 30 days and before each first order."""
    cohort = signups(users, user_type=user_type, client=client).select(F.col("commission_user_id").alias("tree_user_id"), "signup")
    owners = (
        users.select("tree_user_id", "user_id").join(cohort, "tree_user_id").join(_first_order_dates(features), "tree_user_id")
    )
    rows = logins.select("id", "user_id", "platform", "created_at").join(owners, "user_id")
    when = {"first30": days_between(F.col("created_at"), F.col("signup")).between(0, 30)}
    for k in FIRST_ORDERS:
        when[f"before_first_{k}"] = F.col("created_at").between(F.col("signup").cast("timestamp_ntz"), F.col(f"first_{k}"))
    return rows.groupBy("tree_user_id").agg(
        *(
            count_if(platform_is(family, F.col("platform")) & condition, F.col("id")).alias(f"logins_{name}_{family}")
            for name, condition in when.items()
            for family in PLATFORM_FAMILIES
        )
    )


def usage_features(
    users: DataFrame, orders: DataFrame, messages: DataFrame, logins: DataFrame, as_of, user_type: str = "Distributor", client: str | None = None
) -> DataFrame:
    """Order metrics, first/last days, engagement and logins: one row per user with orders.

    The order features are used three times, so they are written once.
    """
    features = cut(user_order_features(users, orders, as_of, user_type, client), "features")
    sent = engagement(users, messages, features, user_type, client).withColumnRenamed("sender_tree_user_id", "commission_user_id")
    visits = login_counts(users, logins, features, user_type, client).withColumnRenamed("tree_user_id", "commission_user_id")
    records = [f"{w}_{k}" for w in ("first", "last") for k in FIRST_ORDERS]
    return features.drop(*records).join(sent, "commission_user_id", "left").join(visits, "commission_user_id", "left")


def own_logins(users: DataFrame, logins: DataFrame) -> DataFrame:
    """Logins a user made in person, with the user's tree id."""
    return logins.filter(F.col("proxied_by_id").isNull()).drop("proxied_by_id").join(
        users.select("user_id", "tree_user_id"), "user_id"
    )
