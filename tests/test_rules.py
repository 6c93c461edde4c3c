import pytest
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import dates
from tidemark.functions import rules as fr
from tidemark.plans import rules

RULES = config.Rules({"north": config.NORMALIZED, "south": config.PASS_THROUGH})
USER = "client string, client_type string, client_status string"


def types(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.mark.parametrize("raw,want", [
    ("Distributor", "Distributor"), ("Pending Transfer", "Distributor"), ("MarketPlace Customer", "Autoship"),
    ("Transfer Customer", "Distributor"), ("UK-Trial", "Distributor"), ("RCSCompany", "Autoship"), ("North", "Autoship"),
])
def test_user_types(frame, raw, want):
    assert types(rules.user_rules(frame(USER, ("North", raw, "Hold")), RULES), "type", "status") == [(want, "Active")]


def test_unknown_user_type_stops(frame):
    with pytest.raises(Exception, match="not found in list"):
        rules.user_rules(frame(USER, ("north", "Martian", "Hold")), RULES).collect()


def test_missing_types_drop_the_row_and_unknown_tenants_go(frame):
    rows = frame(USER, ("north", None, "x"), ("north", "", "x"), ("west", "Import", "x"), ("south", "anything", "x"))
    assert types(rules.user_rules(rows, RULES), "client", "type") == [("south", "anything")]


def test_user_status_defaults_to_inactive_and_null_stays(frame):
    rows = frame(USER, ("north", "Import", "FooBar"), ("north", "Import", None))
    assert types(rules.user_rules(rows, RULES), "status") == [("Inactive",), (None,)]


def test_column_names_are_options(frame):
    got = rules.user_rules(frame("client string, foo string, client_status string", ("north", "Distributor", None)), RULES, "foo", "bar")
    assert types(got, "bar") == [("Distributor",)]


ORDER = "client string, client_user_type string, client_type string, client_status string, created timestamp_ntz, order_date timestamp_ntz, tree_user_id long, sponsor_id long"


@pytest.mark.parametrize("user_type,created,want", [
    ("Distributor", "2020-04-17 14:03:50", "Wholesale"), ("Distributor", "2020-05-17 14:03:50", "Autoship"), ("Customer", "2020-04-17", "Autoship"),
])
def test_order_types(frame, user_type, created, want):
    rows = frame(ORDER, ("north", user_type, "Web", "CC Declined", created, "2020-04-17 14:03:50", 5, 3))
    assert types(rules.order_rules(rows, RULES), "type", "status", "commission_user_id") == [(want, "Inactive", 3)]


def test_owner_may_follow_the_buyers_type(frame):
    rows = frame(ORDER, ("north", "Distributor", "Web", None, "2020-01-01", "2020-01-02", 5, 3), ("south", None, "Web", None, "2020-01-01", "2020-01-02", 6, 3))
    assert types(rules.order_rules(rows, RULES, owner_by="user_type"), "type", "status", "commission_user_id") == [
        ("Wholesale", None, 5), ("Customer", "Active", 6),
    ]


@pytest.mark.parametrize("days,label,code", [(0, "0", "1"), (15, "1-15", "2"), (16, "16-90", "3"), (90, "16-90", "3"), (366, "366-730", "7"), (731, "> 730", "8"), (-1, None, None), (None, None, None)])
def test_day_buckets(frame, days, label, code):
    d = F.col("d")
    row = frame("d int", (days,)).select(dates.bucketize(d, dates.DAY_BUCKETS).alias("l"), dates.bucketize(d, dates.DAY_BUCKETS, True).alias("c")).first()
    assert (row["l"], row["c"]) == (label, code)


def test_first_product_rule_wins(frame):
    texts = ["Reactivation fee", "Monthly RBS", "Activation", "DT Pro Gold", "plain thing", None]
    t = F.col("t")
    rows = frame("t string", *[(x,) for x in texts]).select(fr.product_type(t).alias("p"), fr.membership_type(t).alias("m"), fr.is_college(t).alias("c")).collect()
    assert [tuple(r) for r in rows] == [
        ("fee", "none", False), ("subscription", "rep", False), ("fee", "none", False), ("DT Pro Gold", "dream trips gold", False),
        ("plain thing", "none", False), (None, "none", False),
    ]


def test_platforms(frame):
    given = [None, "Android 9", "iPhone", "iPad", "Windows", "Windows Phone", "Mac OS X", "Macintosh", "linux", "Fedora", "ChromeOS", "Plan 9"]
    want = ["unknown", "android", "iphone", "ipad", "windows", "other", "macos", "macos", "linux", "linux", "chromeos", "other"]
    p = F.col("p")
    rows = frame("p string", *[(g,) for g in given]).select(fr.platform_family(p).alias("f"), *(fr.platform_is(n, p).alias(n) for n in fr.PLATFORM_FAMILIES)).collect()
    assert [r["f"] for r in rows] == want
    for r in rows:
        assert [n for n in fr.PLATFORM_FAMILIES if r[n]] == [r["f"]]


def test_address_and_gender(frame):
    rows = frame("a string, b string, g string", ("1 Road", None, "F"), ("1 Road", "", "male"), ("1 Road", "Flat 2", "?"), (None, "Flat 2", None))
    got = rows.select(fr.street(F.col("a"), F.col("b")).alias("s"), fr.gender(F.col("g")).alias("g")).collect()
    assert [tuple(r) for r in got] == [("1 Road", "female"), ("1 Road", "male"), ("1 Road Flat 2", "none"), (None, "none")]


def test_date_differences(frame):
    row = frame("a timestamp_ntz, b timestamp_ntz", ("2020-01-31 23:00:00", "2020-02-01 01:00:00")).select(
        dates.days_between(F.col("b"), F.col("a")).alias("d"), dates.months_between_boundaries(F.col("b"), F.col("a")).alias("m"),
        dates.complete_units("DAY", F.col("a"), F.col("b")).alias("u"), dates.complete_units("SECOND", F.col("a"), F.col("b")).alias("s"),
    ).first()
    assert tuple(row) == (1, 1, 0, 7200)
