"""Cohort and value reports over conformed users and orders.

Every report takes the two frames already read; ``client`` limits both to a
tenant where they carry that column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import DAY_BUCKETS, bucketize, cohort_keys, days_between, months_between_boundaries
from tidemark.operators import windows
from tidemark.operators.aggregates import (
    GRID_RANGES,
    count_if,
    first_record,
    grid_name,
    grid_over_users,
    grid_per_user,
    last_record,
    ratio,
    share,
    sum_if_or_zero,
)
from tidemark.operators.joins import for_tenant

ORDER_COLUMNS = ["commission_user_id", "tree_user_id", "order_id", "type", "status", "total", "order_date"]


def signups(
    users: DataFrame, created_from=None, created_to=None, user_type: str | None = "Distributor", client: str | None = None
) -> DataFrame:
    """Users with their cohort keys."""
    if client:
        users = for_tenant(users, client)
    if user_type:
        users = users.filter(F.col("type") == user_type)
    if created_from is not None:
        kind = users.schema["created"].dataType
        users = users.filter(F.col("created").between(F.lit(created_from).cast(kind), F.lit(created_to).cast(kind)))
    return users.select(F.col("tree_user_id").alias("commission_user_id"), *cohort_keys(F.col("created")))


def active_orders(orders: DataFrame, types: list[str] | None = None, client: str | None = None, extra=()) -> DataFrame:
    """Orders not cancelled, each once: deliveries repeat, so equal rows collapse.

    The collapse hashes whole rows, order id included, so a user with very many
    orders is spread over all tasks.
    """
    if client:
        orders = for_tenant(orders, client)
    live = orders.filter(F.col("status") != "Cancelled")
    if types:
        live = live.filter(F.col("type").isin(*types))
    return live.select(*ORDER_COLUMNS, *extra).distinct()


def signup_orders(cohort: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders of the cohort's users with days since sign-up.

    An inner join with orders on the splittable side: AQE can split a user who
    holds a large part of all orders. Users without orders are added after the
    grouping, where one row per user is left.
    """
    return orders.join(cohort, "commission_user_id").withColumn(
        "days_to_order", days_between(F.col("order_date"), F.col("signup"))
    )


def _order_record(days: Column | None = None) -> Column:
    fields = ["order_id", "order_date", "total"]
    return F.struct(*fields, (F.col("days_to_order") if days is None else days).alias("days_to_order"))


TIME_ORDER = ("order_date", "order_id")


def _time() -> list[Column]:
    return [F.col(c) for c in TIME_ORDER]


# ---- days to first / last sale ---------------------------------------------


def days_to_first_sale(users: DataFrame, orders: DataFrame, client: str | None = None) -> DataFrame:
    """Users per number of days to their first non-wholesale order, with shares and running shares."""
    rows = signup_orders(signups(users, client=client), active_orders(orders, client=client))
    sale = F.col("type") != "Wholesale"
    firsts = (
        rows.groupBy("commission_user_id")
        .agg(
            # the earliest order by time is also that of the fewest days
            F.min(F.when(sale, F.col("days_to_order"))).alias("days_to_order"),
            F.count_if(sale).alias("sales"),
            F.count_if(F.col("order_id").isNull()).alias("without_id"),
        )
        # users with an order that has no id are left out
        .filter("sales > 0 AND without_id = 0")
    )
    per_day = firsts.groupBy("days_to_order").agg(F.count("*").alias("num"))
    num, from_zero = F.col("num"), F.when(F.col("days_to_order") > -1, F.col("num"))
    return per_day.select(
        F.col("days_to_order").alias("days_to_first_sale"),
        "num",
        share(num, windows.total(num)).alias("percent_of_total"),
        windows.running(num, "days_to_order").alias("running_total"),
        share(windows.running(num, "days_to_order"), windows.total(num)).alias("percent_of_running_total"),
        windows.running(from_zero, "days_to_order").alias("running_total_from_zero"),
        share(windows.running(from_zero, "days_to_order"), windows.total(from_zero)).alias(
            "percent_of_running_total_from_zero"
        ),
    )


def days_to_last_sale(users: DataFrame, orders: DataFrame, created_from, created_to) -> DataFrame:
    """Users per number of days from sign-up to their last retail sale."""
    sales = _sales(users, orders, "Retail", created_from, created_to)
    last = sales.groupBy("commission_user_id", "created").agg(F.max("order_date").alias("last"))
    return last.groupBy(days_between(F.col("last"), F.col("created")).alias("days_to_last_sale")).agg(
        F.count("commission_user_id").alias("num_retail_sales")
    )


def _sales(users: DataFrame, orders: DataFrame, kind: str, created_from, created_to) -> DataFrame:
    stamp = users.schema["created"].dataType
    owners = users.filter(
        F.col("created").between(F.lit(created_from).cast(stamp), F.lit(created_to).cast(stamp))
    ).select(F.col("tree_user_id").alias("commission_user_id"), "created")
    return owners.join(active_orders(orders, [kind]), "commission_user_id")


def first_month_sellers(users: DataFrame, orders: DataFrame, created_from, created_to, horizon: int = 502) -> DataFrame:
    """Users who sold within 30 days of sign-up, with their sales up to the horizon."""
    stamp = users.schema["created"].dataType
    owners = users.filter(
        F.col("created").between(F.lit(created_from).cast(stamp), F.lit(created_to).cast(stamp))
    ).select(F.col("tree_user_id").alias("commission_user_id"), "created")
    days = days_between(F.col("order_date"), F.col("created"))
    retail, wholesale = F.col("type") == "Retail", F.col("type") == "Wholesale"
    zero = F.lit(0).cast("decimal(19,4)")
    per_user = (
        owners.join(active_orders(orders, ["Retail", "Wholesale"]), "commission_user_id")
        .filter(days.between(0, horizon))
        .groupBy("commission_user_id", "created")
        .agg(
            F.min(F.when(retail, F.col("order_date"))).alias("first"),
            F.max(F.when(retail, F.col("order_date"))).alias("last"),
            count_if(retail, F.col("order_id")).alias("active_sales_count"),
            count_if(wholesale, F.col("order_id")).alias("active_wholesale_count"),
            F.sum(F.when(retail, F.coalesce("total", zero))).alias("active_sales_total"),
            F.sum(F.when(wholesale, F.coalesce("total", zero))).alias("active_wholesale_total"),
        )
    )
    to_first = days_between(F.col("first"), F.col("created"))
    return (
        per_user.filter(F.col("active_sales_total").isNotNull() & F.col("active_wholesale_total").isNotNull())
        .filter(to_first.between(0, 30))
        .select(
            "commission_user_id",
            to_first.alias("days_to_first_sale"),
            days_between(F.col("last"), F.col("created")).alias("days_to_last_sale"),
            "active_sales_count",
            "active_wholesale_count",
            "active_sales_total",
            "active_wholesale_total",
        )
        .orderBy(
            F.desc("active_sales_total"), F.desc("active_wholesale_count"), F.desc("days_to_last_sale"), F.asc("days_to_first_sale")
        )
    )


# ---- lifetime and cohort value -----------------------------------------------


def _value_per_user(cohort: DataFrame, orders: DataFrame, sale: Column) -> DataFrame:
    """One row per user: days to first and last ``sale`` and the grid's first level.

    A single grouping serves the buckets and all metrics; users without any
    order stay, users whose orders all precede sign-up go.
    """
    days = F.col("days_to_order")
    rows = signup_orders(cohort, orders).withColumn("_counts", F.coalesce(days >= 0, F.lit(True)))
    qualifies = sale & (days >= 0)
    per_user = rows.groupBy("commission_user_id").agg(
        F.min(F.when(qualifies, days)).alias("first_days"),
        F.max(F.when(qualifies, days)).alias("last_days"),
        F.max("_counts").alias("_counts"),
        *grid_per_user(F.col("type"), days, F.col("order_id"), F.col("total"), F.col("_counts")),
    )
    return (
        cohort.join(per_user, "commission_user_id", "left")
        .filter(F.coalesce("_counts", F.lit(True)))
        .withColumns(
            {
                "days_to_order_bucket": bucketize(F.col("first_days"), DAY_BUCKETS),
                "bucket_order": bucketize(F.col("first_days"), DAY_BUCKETS, code=True),
            }
        )
    )


def _first_last_stats() -> list[Column]:
    return [
        fn(col).alias(f"{name}_days_to_{which}_order")
        for which, col in (("first", "first_days"), ("last", "last_days"))
        for name, fn in (("min", F.min), ("max", F.max), ("avg", F.avg))
    ]


def _totals(span: str = "") -> dict[str, Column]:
    """Averages per user and per sale of one day range."""
    out = {}
    for group, per_user in (("sales", "avg_sales_count_user"), ("wholesale", "avg_wholesale_count_user"), ("", "avg_count_user")):
        n, t, u = (F.col(grid_name(span, group, m)) for m in ("count", "total", "user_count"))
        rev = "rev" if not group else f"{group}_rev"
        out[grid_name(span, group, "count")] = n
        out[f"{span}{per_user}"] = ratio(n, u)
        out[grid_name(span, group, "total")] = t
        out[f"{span}avg_{rev}_sale"] = ratio(t, n)
        # the ranges write the wholesale mean without "avg"
        name = f"{span}{rev}_user" if span and group == "wholesale" else f"{span}avg_{rev}_user"
        out[name] = ratio(t, u)
    return out


def lifetime_value(
    users: DataFrame, orders: DataFrame, created_from=None, created_to=None, client: str | None = None
) -> DataFrame:
    """Value of a sign-up cohort by days to the first non-wholesale order."""
    cohort = signups(users, created_from, created_to, client=client)
    per_user = _value_per_user(cohort, active_orders(orders, client=client), F.col("type") != "Wholesale")
    per_bucket = per_user.groupBy("days_to_order_bucket", "bucket_order").agg(
        F.count("*").alias("mp_count"), *_first_last_stats(), *grid_over_users()
    )
    n = F.col("mp_count")
    overall = windows.total(F.col("total"))
    return per_bucket.select(
        "days_to_order_bucket",
        "mp_count",
        share(n, windows.total(n)).alias("mp_percent_of_total"),
        windows.running(n, "bucket_order").alias("mp_running_total"),
        share(windows.running(n, "bucket_order"), windows.total(n)).alias("mp_percent_of_running_total"),
        "avg_days_to_first_order",
        "avg_days_to_last_order",
        *(c.alias(name) for name, c in _totals().items()),
        F.when(overall > 0, share(F.col("total"), overall)).alias("percent_of_total"),
    )


def cohort_value(
    users: DataFrame, orders: DataFrame, created_from=None, created_to=None, user_type: str | None = "Distributor", client: str | None = None
) -> DataFrame:
    """Value per sign-up month and days to first retail order, split by day range."""
    cohort = signups(users, created_from, created_to, user_type, client)
    per_user = _value_per_user(cohort, active_orders(orders, ["Retail", "Wholesale"], client), F.col("type") == "Retail")
    per_month = per_user.groupBy("year", "month", "days_to_order_bucket", "bucket_order").agg(
        # retail buyers only
        F.count_if(F.coalesce(grid_name("", "sales", "buyer"), F.lit(False))).alias("mp_count"),
        *_first_last_stats(),
        *grid_over_users(),
    )
    month = ["year", "month"]
    n = F.col("mp_count")
    out: dict[str, Column] = {
        "cohort": F.concat("month", F.lit("/"), "year"),
        "year": F.col("year"),
        "month": F.col("month"),
        "days_to_order_bucket": F.col("days_to_order_bucket"),
        "mp_count": n,
        "mp_percent_of_total": share(n, windows.total(n, month)),
        "mp_running_total": windows.running(n, "bucket_order", month),
        "mp_percent_of_running_total": share(windows.running(n, "bucket_order", month), windows.total(n, month)),
        **{f"{s}_days_to_{w}_order": F.col(f"{s}_days_to_{w}_order") for w in ("first", "last") for s in ("min", "max", "avg")},
    }
    for span in GRID_RANGES:
        out.update(_totals(span))
        total = F.col(grid_name(span, "", "total"))
        of_month = windows.total(total, month)
        out[f"{span}percent_of_month_total"] = F.when(of_month > 0, share(total, of_month))
        if span:
            out[f"{span}percent_of_total_count"] = F.when(F.col("count") > 0, share(F.col(f"{span}count"), F.col("count")))
            out[f"{span}percent_of_total_rev"] = F.when(F.col("total") > 0, share(total, F.col("total")))
        if span == "_30_":
            for group in ("sales", "wholesale"):
                for measure in ("count", "total"):
                    whole = F.col(grid_name("", group, measure))
                    out[f"{grid_name(span, group, measure)}_percent"] = F.when(
                        whole > 0, share(F.col(grid_name(span, group, measure)), whole)
                    )
    return per_month.select(*(c.alias(name) for name, c in out.items()))


UPLIFT_RANGES = ["_30_", "_31_90_", "_91_180_", "_181_365_", "_366_730_"]


def uplift(report: DataFrame, more_orders: float = 0.02) -> DataFrame:
    """Revenue gained if every user of ``cohort_value`` ordered a share more, per day range."""
    out: dict[str, Column] = {
        "year": F.col("year"), "month": F.col("month"), "days_to_order_bucket": F.col("days_to_order_bucket"),
        "agg_rev_total": windows.total(F.col("total")), "mp_count": F.col("mp_count"),
    }
    gained = {}
    for span in UPLIFT_RANGES:
        for group in ("sales", "wholesale"):
            per_user, per_sale = f"{span}avg_{group}_count_user", f"{span}avg_{group}_rev_sale"
            out[per_user], out[per_sale] = F.col(per_user), F.col(per_sale)
            out[f"{span}{group}_rev_increase"] = F.col(per_user) * more_orders * F.col(per_sale) * F.col("mp_count")
        gained[span] = F.coalesce(out[f"{span}sales_rev_increase"], F.lit(0.0)) + F.coalesce(
            out[f"{span}wholesale_rev_increase"], F.lit(0.0)
        )
        out[f"{span}total"] = F.col(f"{span}total")
        out[f"{span}total_rev_increase"] = gained[span]
        out[f"{span}agg_rev_increase"] = windows.total(gained[span])
    everything = sum(gained.values(), F.lit(0.0))
    out["agg_rev_increase"] = windows.total(everything)
    return report.select(*(c.alias(name) for name, c in out.items()))


# ---- order mix and per-user order features -----------------------------------


def order_mix(users: DataFrame, orders: DataFrame, user_type: str = "Distributor", client: str | None = None) -> DataFrame:
    """Distinct orders by buyer type, order type and autoship, with shares at three levels."""
    cohort = signups(users, user_type=user_type, client=client).select("commission_user_id")
    live = active_orders(orders, ["Retail", "Wholesale"], client, extra=["is_autoship"])
    buyers = users.select("tree_user_id", F.col("type").alias("user_type"))
    mix = (
        live.join(cohort, "commission_user_id", "left_semi")
        .join(buyers, "tree_user_id")
        .groupBy("user_type", F.col("type").alias("order_type"), "is_autoship")
        .agg(F.count_distinct("order_id").alias("count"))
    )
    n = F.col("count")
    levels = {"types": ["user_type", "order_type"], "user_type": ["user_type"], "all": []}
    out = []
    for level, keys in levels.items():
        over = windows.total(n, keys)
        out += [over.alias(f"count_over_{level}"), F.round(share(n * 100, over), 2).alias(f"per_over_{level}")]
    return mix.select("user_type", "order_type", "is_autoship", "count", *out)


def _kinds() -> dict[str, Column]:
    """Retail, wholesale bought by the user, and wholesale bought for the user (autoship)."""
    own = F.col("commission_user_id") == F.col("tree_user_id")
    wholesale = F.col("type") == "Wholesale"
    return {"retail": F.col("type") == "Retail", "wholesale": wholesale & own, "autoship": wholesale & ~own}


def _user_orders(users: DataFrame, orders: DataFrame, user_type: str, client: str | None) -> DataFrame:
    rows = signup_orders(
        signups(users, user_type=user_type, client=client), active_orders(orders, ["Retail", "Wholesale"], client)
    )
    return rows.filter(F.col("days_to_order") >= 0)


def _first_last_columns(last_of_all: bool) -> list[Column]:
    out = []
    for kind, condition in _kinds().items():
        out.append(first_record(_order_record(), *_time(), when=condition).alias(f"first_{kind}"))
        out.append(last_record(_order_record(), *_time(), when=condition, overall=last_of_all).alias(f"last_{kind}"))
    return out


def _metric_columns(as_of) -> list[Column]:
    today = F.lit(as_of).cast("date")
    months = months_between_boundaries(today, F.to_date("order_date"))
    spans = {"first30_": F.col("days_to_order").between(0, 30), "last12_": months.between(0, 12), "": F.lit(True)}
    out = []
    for span, within in spans.items():
        for kind, condition in _kinds().items():
            out.append(count_if(condition & within, F.col("order_id")).alias(f"count_{span}{kind}"))
            out.append(sum_if_or_zero(condition & within, F.col("total")).alias(f"total_{span}{kind}"))
    return out


def _first_last_days(as_of) -> dict[str, Column]:
    out = {"days_since_signup": days_between(F.lit(as_of).cast("date"), F.col("signup"))}
    for kind in ("retail", "autoship", "wholesale"):
        out[f"days_to_first_{kind}"] = F.col(f"first_{kind}.days_to_order")
        out[f"days_to_last_{kind}"] = F.col(f"last_{kind}.days_to_order")
        out[f"days_active_{kind}"] = days_between(F.col(f"last_{kind}.order_date"), F.col(f"first_{kind}.order_date"))
    return out


def first_last_by_type(
    users: DataFrame, orders: DataFrame, as_of, user_type: str = "Distributor", client: str | None = None, last_of_all: bool = True
) -> DataFrame:
    """First and last order per user and kind.

    As in the report this is taken from, ``last_<kind>`` is NULL unless the
    user's overall last order is of that kind (``last_of_all``).
    """
    per_user = _user_orders(users, orders, user_type, client).groupBy("commission_user_id", "signup").agg(
        *_first_last_columns(last_of_all)
    )
    return per_user.withColumns(_first_last_days(as_of))


def user_order_metrics(
    users: DataFrame, orders: DataFrame, as_of, user_type: str = "Distributor", client: str | None = None
) -> DataFrame:
    """Counts and totals per user and kind: first 30 days, last 12 months, lifetime."""
    return _user_orders(users, orders, user_type, client).groupBy("commission_user_id").agg(*_metric_columns(as_of))


def user_order_features(
    users: DataFrame, orders: DataFrame, as_of, user_type: str = "Distributor", client: str | None = None, last_of_all: bool = True
) -> DataFrame:
    """Metrics and first/last orders in one grouping."""
    per_user = _user_orders(users, orders, user_type, client).groupBy("commission_user_id", "signup").agg(
        *_metric_columns(as_of), *_first_last_columns(last_of_all)
    )
    return per_user.withColumns(_first_last_days(as_of))


def distributor_orders(users: DataFrame, orders: DataFrame, as_of, user_type: str = "Distributor", client: str | None = None) -> DataFrame:
    """Feature table of a distributor's orders: recency, averages, totals and counts per kind."""
    rows = user_order_features(users, orders, as_of, user_type, client, last_of_all=False)
    today = F.lit(as_of).cast("date")
    kinds = ("wholesale", "autoship", "retail")
    out = {"tree_user_id": F.col("commission_user_id")}
    for which in ("first", "last"):
        out.update({f"days_to_{which}_{k}_order": F.col(f"days_to_{which}_{k}") for k in kinds})
    out.update({f"days_since_last_{k}_order": days_between(today, F.col(f"last_{k}.order_date")) for k in kinds})
    for name, span in (("rolling_12_month", "last12_"), ("lifetime", "")):
        for k in kinds:
            n, t = F.col(f"count_{span}{k}"), F.col(f"total_{span}{k}")
            out[f"{name}_avg_{k}_amount"] = ratio(t, n)
            out[f"{name}_total_{k}_amount"] = t
            out[f"{name}_total_{k}_count"] = n
    return rows.select(*(c.alias(name) for name, c in out.items()))
