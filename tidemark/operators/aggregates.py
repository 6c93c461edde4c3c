"""Aggregate expressions shared by the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_if(condition: Column, value: Column) -> Column:
    """Rows that meet the condition and have a value."""
    return F.count(F.when(condition, value))


def sum_if(condition: Column, value: Column) -> Column:
    """NULL where no row meets the condition."""
    return F.sum(F.when(condition, value))


def sum_if_or_zero(condition: Column, value: Column) -> Column:
    """Zero where no row meets the condition."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("decimal(19,4)")))


def first_record(record: Column, *order: Column, when: Column | None = None) -> Column:
    """Earliest record (of those meeting ``when``); NULL where there is none."""
    key = F.struct(*order)
    return F.min_by(record, key if when is None else F.when(when, key))


def last_record(record: Column, *order: Column, when: Column | None = None, overall: bool = False) -> Column:
    """Latest record of those meeting ``when``.

    With ``overall`` the record is given only if the latest of *all* rows meets
    ``when``, else NULL.
    """
    key = F.struct(*order)
    if when is None:
        return F.max_by(record, key)
    if overall:
        return F.max_by(F.when(when, record), key)
    return F.max_by(record, F.when(when, key))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double where ``part > 0``, else NULL."""
    return F.when(part > 0, F.try_divide(part.cast("double"), whole.cast("double")))


def share(part: Column, whole: Column) -> Column:
    """Plain quotient as a double; NULL where the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


# Order-type groups and day ranges of the metric grid. Fixed values.
GRID_TYPES: Mapping[str, tuple[str, ...]] = {
    "sales": ("Retail",),
    "wholesale": ("Wholesale",),
    "": ("Retail", "Wholesale"),
}
GRID_RANGES: Mapping[str, tuple[int, int | None] | None] = {
    "": None,
    "_30_": (0, 30),
    "_31_90_": (31, 90),
    "_91_180_": (91, 180),
    "_181_365_": (181, 365),
    "_366_730_": (366, 730),
    "_730_": (731, None),
}


def grid_name(span: str, group: str, measure: str) -> str:
    """``_30_sales_count``, ``wholesale_total``, ``user_count`` ..."""
    return span + "_".join(p for p in (group, measure) if p)


def _in_range(days: Column, span: str, counts: Column) -> Column:
    bounds = GRID_RANGES[span]
    if bounds is None:
        return counts
    low, high = bounds
    return days >= low if high is None else days.between(low, high)


def grid_per_user(type_: Column, days: Column, order_id: Column, total: Column, counts: Column) -> list[Column]:
    """First level of the grid: count, sum and flag per user, order type and day range.

    ``counts`` tells which rows count for the whole span.
    """
    out = []
    for span in GRID_RANGES:
        for group in ("sales", "wholesale"):
            wanted = type_.isin(*GRID_TYPES[group]) & _in_range(days, span, counts)
            out.append(count_if(wanted, order_id).alias(grid_name(span, group, "count")))
            out.append(sum_if(wanted, total).alias(grid_name(span, group, "total")))
            # an order without id still makes its user a buyer
            out.append(F.max(wanted).alias(grid_name(span, group, "buyer")))
    return out


def grid_over_users() -> list[Column]:
    """Second level: add users up; distinct users are those with the flag set.

    Two levels replace 21 COUNT(DISTINCT IF ...), which would copy every row
    once per distinct expression before the shuffle.
    """
    out = []
    for span in GRID_RANGES:
        for group, members in (("sales", ["sales"]), ("wholesale", ["wholesale"]), ("", ["sales", "wholesale"])):
            counts = [F.coalesce(F.sum(grid_name(span, m, "count")), F.lit(0)) for m in members]
            out.append(_plus(counts).alias(grid_name(span, group, "count")))
            totals = [F.sum(grid_name(span, m, "total")) for m in members]
            out.append(_plus_or_null(totals).alias(grid_name(span, group, "total")))
            flags = [F.coalesce(F.col(grid_name(span, m, "buyer")), F.lit(False)) for m in members]
            buyer = flags[0] if len(flags) == 1 else flags[0] | flags[1]
            out.append(F.count_if(buyer).alias(grid_name(span, group, "user_count")))
    return out


def _plus(columns: Sequence[Column]) -> Column:
    return columns[0] if len(columns) == 1 else columns[0] + columns[1]


def _plus_or_null(columns: Sequence[Column]) -> Column:
    """Sum of both, NULL only where both are NULL."""
    if len(columns) == 1:
        return columns[0]
    a, b = columns
    return F.coalesce(a + b, a, b)
