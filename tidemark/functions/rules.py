"""Ordered rules turned into one CASE expression: first match wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(cases: Sequence[tuple[Column, Column]], default: Column | None = None) -> Column:
    chain = None
    for condition, value in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    if chain is None:
        return F.lit(None) if default is None else default
    return chain if default is None else chain.otherwise(default)


def like_any(text: Column, patterns: Sequence[str]) -> Column:
    condition = text.like(patterns[0])
    for pattern in patterns[1:]:
        condition = condition | text.like(pattern)
    return condition


def classify(text: Column, rules: Sequence[tuple[Sequence[str], str]], default: Column) -> Column:
    """First rule one of whose LIKE patterns fits the lower-cased text."""
    low = F.lower(text)
    return first_match([(like_any(low, patterns), F.lit(label)) for patterns, label in rules], default)


def map_values(text: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """Exact lookup in a small fixed table; several keys of one label share a branch."""
    by_label: dict[str, list[str]] = {}
    for key, label in table.items():
        by_label.setdefault(label, []).append(key)
    return first_match([(text.isin(*keys), F.lit(label)) for label, keys in by_label.items()], default)


# Product text rules. They decide the reports' classes, in this order.
PRODUCT_TYPE_RULES = [
    (["%reactivation%"], "fee"),
    (["%m%nth%"], "subscription"),
    (["%tax%"], "tax"),
    (["%fee%"], "fee"),
    (["%initial%free%"], "discount"),
    (["%get4discount%"], "discount"),
    (["%activation%"], "fee"),
    (["%event%"], "event"),
    (["%boot%camp%"], "event"),
    (["%momentum%"], "event"),
    (["%view%"], "event"),
    (["%acceleration%"], "event"),
    (["%pick your product%"], "product"),
]
MEMBERSHIP_RULES = [
    (["%rbs%"], "rep"),
    (["%dtp%"], "dream trips platinum"),
    (["%dtg%", "%dt%gold%"], "dream trips gold"),
    (["%dts%"], "dream trips silver"),
    (["%dtu%"], "dream trips u"),
    (["%wva%"], "worldventures a"),
]
COLLEGE_PATTERN = "%college%"

# Login platforms. Fixed values: (family, LIKE patterns of the reported platform).
PLATFORM_RULES = [
    ("android", ["Android%"]),
    ("iphone", ["iPhone%"]),
    ("ipad", ["iPad%"]),
    ("windows", ["Windows"]),
    ("macos", ["Macintosh", "%OS X%"]),
    ("linux", ["Linux%", "linux%", "Fedora"]),
    ("chromeos", ["ChromeOS"]),
]
PLATFORM_FAMILIES = ["unknown", *(family for family, _ in PLATFORM_RULES), "other"]

# Gender spellings. Fixed values; anything else is 'none'.
GENDERS = {"F": "female", "female": "female", "M": "male", "male": "male"}


def product_type(description: Column) -> Column:
    """Class of a product text; the text itself where no rule fits."""
    return classify(description, PRODUCT_TYPE_RULES, description)


def membership_type(description: Column) -> Column:
    return classify(description, MEMBERSHIP_RULES, F.lit("none"))


def is_college(description: Column) -> Column:
    return F.coalesce(F.lower(description).like(COLLEGE_PATTERN), F.lit(False))


def platform_is(family: str, platform: Column) -> Column:
    """Whether a platform counts for a family (families may overlap, as patterns do)."""
    if family == "unknown":
        return platform.isNull()
    known = [like_any(platform, patterns) for _, patterns in PLATFORM_RULES]
    if family == "other":
        none = ~known[0]
        for condition in known[1:]:
            none = none & ~condition
        return none
    return known[[name for name, _ in PLATFORM_RULES].index(family)]


def platform_family(platform: Column) -> Column:
    """The first family a platform fits, as one label."""
    cases = [(platform.isNull(), F.lit("unknown"))]
    cases += [(like_any(platform, patterns), F.lit(family)) for family, patterns in PLATFORM_RULES]
    return first_match(cases, F.lit("other"))


def gender(value: Column) -> Column:
    return map_values(value, GENDERS, F.lit("none"))


def street(line1: Column, line2: Column) -> Column:
    """Both address lines with a blank between; NULL without a first line."""
    second = F.when(F.coalesce(line2, F.lit("")) != "", F.concat(F.lit(" "), line2)).otherwise("")
    return F.concat(line1, second)


def flag(amount: Column) -> Column:
    """True for a positive number; False for NULL."""
    return F.coalesce(amount > 0, F.lit(False))
