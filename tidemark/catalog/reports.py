"""Cohort, value, usage and tree reports on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.adapters import Star
from tidemark.catalog.base import AS_OF, HIGH, LOW, query
from tidemark.functions import rules
from tidemark.operators.versions import union_all
from tidemark.plans import chain, cohort, profile, tree, usage

# ---- cohort and value reports -------------------------------------------------


@query("days_to_first_sale")
def _(s: Star) -> DataFrame:
    return cohort.days_to_first_sale(s.users(), s.orders())


@query("days_to_last_sale")
def _(s: Star) -> DataFrame:
    return cohort.days_to_last_sale(s.users(), s.orders(), LOW, HIGH)


@query("lifetime_value")
def _(s: Star) -> DataFrame:
    return cohort.lifetime_value(s.users(), s.orders(), LOW, HIGH)


@query("lifetime_value_of_tenant")
def _(s: Star) -> DataFrame:
    """The same report for one tenant, named in another case."""
    owners = s.users().selectExpr("tree_user_id AS commission_user_id", "client")
    return cohort.lifetime_value(s.users(), s.orders().join(owners, "commission_user_id"), LOW, HIGH, client="Europe")


#: The reports of a tenant's chain, and the measure that is added up to compare them.
CHAIN = {
    "days_to_first_sale": (lambda b: cohort.days_to_first_sale(b.users, b.orders), "num"),
    "days_to_last_sale": (lambda b: cohort.days_to_last_sale(b.users, b.orders, LOW, HIGH), "num_retail_sales"),
    "lifetime_value": (lambda b: cohort.lifetime_value(b.users, b.orders, LOW, HIGH), "sales_count"),
    "first_30_day_sellers": (lambda b: cohort.first_month_sellers(b.users, b.orders, LOW, HIGH), "active_sales_count"),
    "order_mix_shares": (lambda b: cohort.order_mix(b.users, b.orders), "count"),
}


@query("tenant_report_chain")
def _(s: Star) -> DataFrame:
    """Five reports of one tenant in one run over one base: rows and a sum of each."""
    done = chain.run_reports(s.users(), s.orders(), "Europe", {name: report for name, (report, _) in CHAIN.items()})
    return union_all(
        df.agg(F.lit(name).alias("report"), F.count("*").alias("n"), F.sum(CHAIN[name][1]).cast("long").alias("measure")) for name, df in done.items()
    )


@query("cohort_value")
def _(s: Star) -> DataFrame:
    return cohort.cohort_value(s.users(), s.orders(), LOW, HIGH)


@query("cohort_uplift")
def _(s: Star) -> DataFrame:
    gained = cohort.uplift(cohort.cohort_value(s.users(), s.orders(), LOW, HIGH))
    sums = {c: F.round(c, 2 if c.endswith(("agg_rev_increase", "agg_rev_total")) else 4) for c in gained.columns if "increase" in c or c == "agg_rev_total"}
    return gained.withColumns(sums)


@query("first_30_day_sellers")
def _(s: Star) -> DataFrame:
    return cohort.first_month_sellers(s.users(), s.orders(), LOW, HIGH)


@query("order_mix_shares")
def _(s: Star) -> DataFrame:
    return cohort.order_mix(s.users(), s.orders())


@query("first_last_by_type")
def _(s: Star) -> DataFrame:
    rows = cohort.first_last_by_type(s.users(), s.orders(), AS_OF)
    ends = [f"{w}_{k}" for w in ("first", "last") for k in ("retail", "wholesale", "autoship")]
    return rows.withColumns({f"{e}_order_id": F.col(f"{e}.order_id") for e in ends}).drop(*ends)


@query("user_order_metrics")
def _(s: Star) -> DataFrame:
    return cohort.user_order_metrics(s.users(), s.orders(), AS_OF)


@query("distributor_orders")
def _(s: Star) -> DataFrame:
    return cohort.distributor_orders(s.users(), s.orders(), AS_OF)


# ---- usage features ---------------------------------------------------------------


def _features(s: Star) -> DataFrame:
    return cohort.user_order_features(s.users(), s.orders(), AS_OF)


@query("engagement_features")
def _(s: Star) -> DataFrame:
    return usage.engagement(s.users(), s.messages(), _features(s))


@query("login_platform_counts")
def _(s: Star) -> DataFrame:
    return usage.login_counts(s.users(), s.logins(), _features(s))


@query("usage_features")
def _(s: Star) -> DataFrame:
    return usage.usage_features(s.users(), s.orders(), s.messages(), s.logins(), AS_OF)


@query("own_logins")
def _(s: Star) -> DataFrame:
    return usage.own_logins(s.users(), s.logins())


# ---- tree reports -------------------------------------------------------------------


def _members(s: Star) -> DataFrame:
    """Users of the tree reports: coded in the span, no household accounts."""
    return s.users().filter("client_type <> 'HOUSEHOLD' AND coded >= timestamp_ntz'1995-02-01 00:00:00'")


@query("downline_value")
def _(s: Star) -> DataFrame:
    report = tree.downline_value(_members(s), s.order_products())
    return report.withColumn("avg_days_to_signup", F.round("avg_days_to_signup", 6))


@query("subscription_revenue")
def _(s: Star) -> DataFrame:
    return tree.subscription_revenue(_members(s), s.order_products())


@query("product_classes")
def _(s: Star) -> DataFrame:
    text = F.col("product_description")
    return (
        s.order_products()
        .select(rules.product_type(text).alias("product_type"), rules.membership_type(text).alias("membership_type"), rules.is_college(text).alias("is_college"), "price_total")
        .groupBy("product_type", "membership_type", "is_college")
        .agg(F.count("*").alias("n"), F.sum("price_total").alias("total"))
    )


@query("sponsored_signups")
def _(s: Star) -> DataFrame:
    return tree.sponsored_signups(s.users(), s.upline())


@query("sponsored_orders")
def _(s: Star) -> DataFrame:
    return tree.sponsored_orders(s.users(), s.upline(), s.orders())


@query("generations")
def _(s: Star) -> DataFrame:
    return tree.distributor_downlines(s.users(), s.orders(), AS_OF)


def _book(s: Star) -> DataFrame:
    return s.table("customer").selectExpr(
        "c_custkey AS customer_id", "CASE WHEN c_custkey > 0 THEN c_custkey div 10 END AS sponsor_id",
        "c_custkey * 10 + 1 AS left_id", "c_custkey * 10 + 9 AS right_id",
    )


@query("sponsor_edges")
def _(s: Star) -> DataFrame:
    return tree.sponsor_edges(_book(s))


@query("direct_sponsor")
def _(s: Star) -> DataFrame:
    return tree.direct_sponsor(tree.sponsor_edges(_book(s)), s.table("customer").withColumnRenamed("c_custkey", "customer_id"), 137)


@query("table_profile")
def _(s: Star) -> DataFrame:
    return profile.table_profile(
        {
            "customer": (s.table("customer"), None),
            "events": (s.table("events"), "ts"),
            "lineitem": (s.table("lineitem"), "l_shipdate"),
            "orders": (s.table("orders"), "o_orderdate"),
            "documents": (s.table("documents"), None),
        }
    )
