"""Sponsor-tree reports: recruits, downline value, generations, graph edges."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import FINE_DAY_BUCKETS, bucketize, complete_units, days_between
from tidemark.functions.rules import membership_type, product_type
from tidemark.operators.aggregates import count_if, share, sum_if, sum_if_or_zero
from tidemark.operators.versions import union_all
from tidemark.session import cut


def _item_classes() -> dict[str, Column]:
    """Sums the downline report keeps per user: (product class, rep or not)."""
    rep = F.col("membership_type") == "rep"
    kind = F.col("product_type")
    out = {}
    for who, mine in (("vaca", ~rep), ("rep", rep)):
        for name, label in (("fees", "fee"), ("discounts", "discount"), ("subs", "subscription")):
            out[f"{who}_{name}"] = (kind == label) & mine
    out["event"] = kind == "event"
    out["product"] = kind == "product"
    return out


def _classified(items: DataFrame) -> DataFrame:
    text = F.col("product_description")
    return items.withColumns({"product_type": product_type(text), "membership_type": membership_type(text)})


def recruits(users: DataFrame) -> DataFrame:
    """Per sponsor: recruits after the own coding date, days to the first, their mean and maximum.

    Recruits are counted per (sponsor, day) before the join with the sponsor, so
    a sponsor of millions is a few thousand rows there.
    """
    per_day = (
        users.filter(F.col("sponsor_id").isNotNull())
        .groupBy(F.col("sponsor_id").alias("tree_user_id"), F.to_date("coded").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    days = days_between(F.col("day"), F.col("coded"))
    return (
        users.select("tree_user_id", "coded")
        .join(per_day, "tree_user_id")
        .withColumn("days", days)
        .filter("days > 0")
        .groupBy("tree_user_id")
        .agg(
            F.sum("n").alias("sponsored_cnt"),
            F.coalesce(F.sum(F.when(F.col("days").between(0, 30), F.col("n"))), F.lit(0)).alias("first_30_cnt"),
            share(F.sum(F.col("n") * F.col("days")), F.sum("n")).alias("avg_days_to_signup"),
            F.min("days").alias("min_days_to_signup"),
            F.max("days").alias("max_days_to_signup"),
        )
    )


def downline_value(users: DataFrame, items: DataFrame) -> DataFrame:
    """Value of distributors by days to their first recruit.

    ``users`` are already limited to tenant, country and coding date; ``items``
    are order items with ``tree_user_id``, ``status`` and ``product_description``.
    """
    sums = []
    for name, condition in _item_classes().items():
        sums.append(count_if(condition, F.col("order_id")).alias(f"{name}_cnt"))
        sums.append(sum_if_or_zero(condition, F.col("price_total")).alias(f"{name}_tot"))
    bought = _classified(items.filter("status = 'Active'")).groupBy("tree_user_id").agg(*sums, F.sum("price_total").alias("tot"))
    rows = (
        users.filter("type = 'Distributor'").select("tree_user_id")
        .join(recruits(users), "tree_user_id", "left")
        .join(bought, "tree_user_id", "left")
        .withColumns(
            {
                "bucket": bucketize(F.col("min_days_to_signup"), FINE_DAY_BUCKETS),
                "bucket_order": bucketize(F.col("min_days_to_signup"), FINE_DAY_BUCKETS, code=True),
            }
        )
    )
    out = [
        F.count("*").alias("cnt"),
        F.sum("sponsored_cnt").alias("sponsored_cnt"),
        F.sum("first_30_cnt").alias("sponsored_first_30_cnt"),
        F.avg("avg_days_to_signup").alias("avg_days_to_signup"),
        F.avg("min_days_to_signup").alias("avg_min_days_to_signup"),
        F.avg("max_days_to_signup").alias("avg_max_days_to_signup"),
        F.avg(F.col("max_days_to_signup") - F.col("min_days_to_signup")).alias("avg_days_active"),
    ]
    for name in _item_classes():
        for measure in ("cnt", "tot"):
            column = f"{name}_{measure}"
            out.append(F.sum(F.coalesce(column, F.lit(0))).alias(column))
    out.append(F.sum(F.coalesce("tot", F.lit(0))).alias("tot"))
    report = rows.groupBy("bucket", "bucket_order").agg(*out)
    return report.withColumns(
        {
            "vaca_subs_per_user": share(F.col("vaca_subs_cnt"), F.col("cnt")),
            "vaca_subs_tot_per_user": share(F.col("vaca_subs_tot"), F.col("cnt")),
            "reps_subs_per_user": share(F.col("rep_subs_cnt"), F.col("cnt")),
            "reps_subs_tot_per_user": share(F.col("rep_subs_tot"), F.col("cnt")),
            "avg_rev_per_user": share(F.col("tot"), F.col("cnt")),
        }
    ).orderBy("bucket_order").drop("bucket_order")


def subscription_revenue(users: DataFrame, items: DataFrame) -> DataFrame:
    """Subscription items, buyers and revenue per membership type."""
    subs = _classified(items.filter("status = 'Active'")).filter("product_type = 'subscription'")
    # per buyer first: the second level counts buyers without a distinct
    per_user = subs.groupBy("membership_type", "tree_user_id").agg(F.count("*").alias("n"), F.sum("price_total").alias("t"))
    report = per_user.join(users.select("tree_user_id"), "tree_user_id", "left_semi").groupBy("membership_type").agg(
        F.sum("n").alias("cnt"), F.count("*").alias("distinct_users"), F.sum("t").alias("total")
    )
    return report.withColumn("avg_tot_per_user", share(F.col("total"), F.col("distinct_users")))


def sponsored_signups(users: DataFrame, upline: DataFrame, client: str | None = None) -> DataFrame:
    """Downline members who signed up within 7 / 30 days of each upline member's own sign-up.

    Members of one tenant only. Members are counted per (upline, sign-up time)
    before the join with the upline, which may hold a large part of the tree.
    """
    if client:
        users = users.filter(F.lower("client") == client.lower())
    member = users.select("client", "tree_user_id", F.col("created").alias("joined"))
    counted = upline.join(member, "tree_user_id").groupBy("client", "upline_id", "joined").agg(F.count("*").alias("n"))
    head = users.select("client", F.col("tree_user_id").alias("upline_id"), "created")
    days = complete_units("DAY", F.col("created"), F.col("joined"))
    return (
        counted.join(head, ["client", "upline_id"])
        .withColumn("days", days)
        .filter("days < 31")
        .groupBy("client", F.col("upline_id").alias("user_id"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("days") < 8, F.col("n"))), F.lit(0)).alias("signups_7_days"),
            F.sum("n").alias("signups_30_days"),
        )
    )


VOLUMES = {"total": "total", "personal_volume": "bv_total", "commissionable_volume": "cv_total"}


def sponsored_orders(users: DataFrame, upline: DataFrame, orders: DataFrame, client: str | None = None) -> DataFrame:
    """Orders of the downline before, and 7 / 30 days after, each upline member's sign-up."""
    if client:
        users = users.filter(F.lower("client") == client.lower())
    sums = [F.sum(c).alias(c) for c in VOLUMES.values()]
    # add up per member and time, then per upline and time, before any range test
    bought = orders.groupBy("tree_user_id", "order_date").agg(F.count("order_id").alias("n"), *sums)
    mine = bought.join(users.select("tree_user_id", "client"), "tree_user_id")
    per_head = upline.join(mine, "tree_user_id").groupBy("client", "upline_id", "order_date").agg(F.sum("n").alias("n"), *sums)
    head = users.select("client", F.col("tree_user_id").alias("upline_id"), "created")
    rows = (
        per_head.join(head, ["client", "upline_id"])
        .withColumns(
            {
                "secs": complete_units("SECOND", F.col("created"), F.col("order_date")),
                "days": complete_units("DAY", F.col("created"), F.col("order_date")),
            }
        )
        .filter("days < 31")
    )
    after = F.col("secs") > -1
    spans = {"before_signup": F.col("secs") < 0, "first_7_after_signup": after & (F.col("days") < 8), "first_30_after_signup": after}
    out = [F.min("secs").alias("sponsored_seconds_from_signup_to_first_order")]
    for name, condition in spans.items():
        out.append(F.coalesce(sum_if(condition, F.col("n")), F.lit(0)).alias(f"sponsored_orders_{name}"))
        out += [sum_if(condition, F.col(c)).alias(f"sponsored_{label}_{name}") for label, c in VOLUMES.items()]
    return rows.groupBy("client", F.col("upline_id").alias("user_id")).agg(*out)


def downline_rollup(members: DataFrame, measures: Mapping[str, Column], generations: int = 6) -> DataFrame:
    """Sums of each measure over every generation below a member.

    A member's generation ``g`` is the sum of the children's generation ``g-1``,
    so each step is one grouping by sponsor (combined before the shuffle) and one
    join of two keyed sets. A step reads the sums of the step before only, which
    are written once, as is the base. No member-ancestor pair is ever built.
    Columns are ``<measure>_g1`` ... ``<measure>_g<generations>``.
    """
    base = cut(members.select("tree_user_id", "sponsor_id", *(F.coalesce(c, F.lit(0)).alias(m) for m, c in measures.items())), "members")
    sponsors, layer, layers = base.select("tree_user_id", "sponsor_id"), base, []
    for depth in range(1, generations + 1):
        below = layer.filter(F.col("sponsor_id").isNotNull()).groupBy(F.col("sponsor_id").alias("tree_user_id")).agg(*(F.sum(m).alias(m) for m in measures))
        below = cut(below, "generation")
        layers.append(below.withColumn("_g", F.lit(depth)))
        layer = sponsors.join(below, "tree_user_id")
    names = {f"{m}_g{g}": F.sum(F.when(F.col("_g") == g, F.col(m))) for g in range(1, generations + 1) for m in measures}
    wide = union_all(layers).groupBy("tree_user_id").agg(*(c.alias(n) for n, c in names.items()))
    return base.select("tree_user_id").join(wide, "tree_user_id", "left").na.fill(0, list(names))


def distributor_downlines(users: DataFrame, orders: DataFrame, as_of, generations: int = 6) -> DataFrame:
    """Feature table of a distributor's downline by generation: head counts and their
    orders' value, lifetime and over the 12 months before ``as_of``."""
    today = F.lit(as_of).cast("timestamp_ntz")
    year_ago = today - F.expr("INTERVAL 12 MONTHS")
    sold = orders.filter("status <> 'Cancelled'").groupBy(F.col("commission_user_id").alias("tree_user_id")).agg(
        F.sum("total").alias("lcv"),
        sum_if_or_zero(F.col("order_date").between(year_ago, today), F.col("total")).alias("lcv_12"),
    )
    members = users.join(sold, "tree_user_id", "left")
    distributor = F.col("type") == "Distributor"
    recent = distributor & F.col("created").between(year_ago, today)
    sums = downline_rollup(
        members,
        {
            "count": F.when(distributor, 1).otherwise(0).cast("long"),
            "count_12": F.when(recent, 1).otherwise(0).cast("long"),
            "lcv": F.when(distributor, F.col("lcv")).cast("decimal(29,4)"),
            "lcv_12": F.when(distributor, F.col("lcv_12")).cast("decimal(29,4)"),
        },
        generations,
    )
    direct = users.filter(distributor & F.col("sponsor_id").isNotNull()).groupBy(F.col("sponsor_id").alias("tree_user_id")).agg(
        F.min("created").alias("first_recruit"),
        F.count_if(F.col("created").between(today - F.expr("INTERVAL 30 DAYS"), today)).alias("downline_distributor_signups_last_30"),
    )
    out = {"days_to_first_downline_distributor": days_between(F.col("first_recruit"), F.col("created"))}
    out["downline_distributor_signups_last_30"] = F.coalesce("downline_distributor_signups_last_30", F.lit(0))
    for measure, name in (("count_12", "rolling_12_month_gen{}_distributors_count"), ("count", "gen{}_distributors_count"),
                          ("lcv_12", "rolling_12_month_gen{}_distributors_lcv"), ("lcv", "gen{}_distributors_lcv")):
        out.update({name.format(g): F.col(f"{measure}_g{g}") for g in range(1, generations + 1)})
    return (
        users.filter(distributor).select("client", "tree_user_id", "created")
        .join(sums, "tree_user_id", "left").join(direct, "tree_user_id", "left")
        .select("client", "tree_user_id", *(c.alias(n) for n, c in out.items()))
    )


def sponsor_edges(tree: DataFrame) -> DataFrame:
    """Edges between existing customers: ``sponsored_by`` and ``sponsoring`` (left and right leg).

    Customer 0 is the root of the book, not a person: it starts no edge.
    """
    legs = F.array(
        F.struct(F.lit("sponsored_by").alias("kind"), F.col("sponsor_id").alias("target_id")),
        F.struct(F.lit("sponsoring").alias("kind"), F.col("left_id").alias("target_id")),
        F.struct(F.lit("sponsoring").alias("kind"), F.col("right_id").alias("target_id")),
    )
    edges = tree.filter("customer_id <> 0").select("customer_id", F.inline(legs)).filter("target_id IS NOT NULL")
    nodes = tree.select(F.col("customer_id").alias("target_id"))
    return edges.join(nodes, "target_id", "left_semi").select("customer_id", "kind", "target_id")


def direct_sponsor(edges: DataFrame, customers: DataFrame, customer_id: int) -> DataFrame:
    """The customer row(s) that sponsor one customer."""
    found = edges.filter((F.col("customer_id") == customer_id) & (F.col("kind") == "sponsored_by"))
    return customers.join(found.select(F.col("target_id").alias("customer_id")), "customer_id", "left_semi")
