"""Several reports of one tenant in one run, over a base that is computed once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import for_tenant
from tidemark.plans.cohort import active_orders
from tidemark.session import cut


class Base(NamedTuple):
    """What the reports of a tenant share: its users, and its orders not cancelled, each once, whose owner is among them."""

    users: DataFrame
    orders: DataFrame


Report = Callable[[Base], DataFrame]


def tenant_base(users: DataFrame, orders: DataFrame, client: str, extra: Sequence[str] = ("is_autoship",)) -> Base:
    """Read users and orders once, keep the tenant's and write both, with ``extra`` columns of the orders that a report
    reads. Orders that name no tenant are their owner's."""
    mine = cut(for_tenant(users, client), "tenant-users")
    if "client" in orders.columns:
        return Base(mine, cut(active_orders(orders, client=client, extra=("client", *extra)), "tenant-orders"))
    owners = mine.select(F.col("tree_user_id").alias("commission_user_id"))
    return Base(mine, cut(active_orders(orders.join(owners, "commission_user_id", "left_semi"), extra=extra), "tenant-orders"))


def run_reports(users: DataFrame, orders: DataFrame, client: str, reports: Mapping[str, Report]) -> dict[str, DataFrame]:
    """Every report of the chain for the tenant, each written once; the source tables are read for the base alone."""
    base = tenant_base(users, orders, client)
    return {name: cut(report(base), f"report-{name}") for name, report in reports.items()}
