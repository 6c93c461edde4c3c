"""Day buckets, calendar differences and lenient temporal parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.rules import first_match

# Day buckets of the value reports: (first day, last day, label, sort code). Fixed values.
DAY_BUCKETS = [
    (0, 0, "0", "1"),
    (1, 15, "1-15", "2"),
    (16, 90, "16-90", "3"),
    (91, 180, "91-180", "5"),
    (181, 365, "181-365", "6"),
    (366, 730, "366-730", "7"),
    (731, None, "> 730", "8"),
]
# Finer buckets of the downline report. Fixed values.
FINE_DAY_BUCKETS = [
    (0, 0, "0", "1"),
    (1, 15, "1-15", "2"),
    (16, 30, "16-30", "3"),
    (31, 90, "31-90", "4"),
    (91, 180, "91-180", "5"),
    (181, 365, "181-365", "6"),
    (366, 730, "366-730", "7"),
    (731, None, "> 730", "8"),
]


def bucketize(days: Column, buckets: Sequence[tuple[int, int | None, str, str]], code: bool = False) -> Column:
    """Label (or sort code) of a day number; NULL for negative or missing days."""
    return first_match(
        [
            (days >= low if high is None else days.between(low, high), F.lit(order if code else label))
            for low, high, label, order in buckets
        ]
    )


def days_between(later: Column, earlier: Column) -> Column:
    """Calendar days."""
    return F.date_diff(F.to_date(later), F.to_date(earlier))


def months_between_boundaries(later: Column, earlier: Column) -> Column:
    """Month boundaries crossed, whatever the day of the month."""
    return (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))


def complete_units(unit: str, earlier: Column, later: Column) -> Column:
    """Whole elapsed YEAR / DAY / SECOND units."""
    return F.timestamp_diff(unit, earlier, later)


def cohort_keys(created: Column) -> list[Column]:
    """Cohort ``year``, zero-padded ``month`` and ``signup`` date."""
    return [
        F.date_format(created, "yyyy").alias("year"),
        F.date_format(created, "MM").alias("month"),
        F.to_date(created).alias("signup"),
    ]


# Spellings accepted besides ISO. Fixed values.
LENIENT_FORMATS = ["yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "yyyyMMdd"]


def parse_wall_time(text: Column) -> Column:
    """Timestamp without zone; an offset in the text is dropped, its wall time kept."""
    others = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in LENIENT_FORMATS]
    return F.coalesce(text.try_cast("timestamp_ntz"), *others)


def parse_instant(text: Column) -> Column:
    """Timestamp of an instant; an offset in the text is applied."""
    return F.coalesce(text.try_cast("timestamp"), *(F.try_to_timestamp(text, F.lit(f)) for f in LENIENT_FORMATS))


def is_temporal(text: Column) -> Column:
    return parse_wall_time(text).isNotNull()
