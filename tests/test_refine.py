"""Refine jobs on invented change records of two tenants."""

import pytest

from tidemark import config
from tidemark.adapters import Lake, Star
from tidemark.operators.versions import history_of, latest_by
from tidemark.plans import refine

RULES = config.Rules({"north": config.NORMALIZED, "south": config.PASS_THROUGH})
V = "client string, event_id string, ingested_at timestamp_ntz"
START, END = "1970-01-01", "2030-01-01"


def version(client, day, ingest=None):
    return (client, f"z/{day.replace('-', '/')}", ingest or day)


@pytest.fixture()
def tenants(spark):
    return config.tenants(spark, [{"client": "north", "partition_id": 2, "partner_id": "n"}, {"client": "south", "partition_id": 4, "partner_id": "s"}])


def dimension(frame, *words):
    return frame(f"{V}, id long, description string", *[(*version(c, "2019-01-01"), i + 1, w) for c in ("north", "south") for i, w in enumerate(words)])


@pytest.fixture()
def lake(frame):
    user = ("id long, sponsor_id long, parent_id long, user_type_id long, user_status_id long, rank_id long, paid_rank_id long, zip string,"
            " created_date timestamp_ntz, updated_date timestamp_ntz, coded_date timestamp_ntz, first_name string, last_name string, company_name string,"
            " address1 string, address2 string, city string, state string, country string, email string, phone string, mobile_phone string, gender string, birth_date date")

    def u(client, day, id_, type_, rank, zip_, ingest=None):
        return (*version(client, day, ingest), id_, 1, 1, type_, 1, rank, 10, zip_, "2018-01-01", "2018-01-01", "2018-01-01", "F", "L", None, "1 Road", None, "C", "S", "US", "e", "p", "m", "F", "1990-01-01")

    order = ("id long, tree_user_id long, autoship_template_id long, order_status_id long, order_type_id long, client_order_id long, client_user_id string,"
             + ", ".join(f"{c} string" for c in ("currency_code", "discount_code", "timezone", "tracking_number", "shipping_city", "shipping_state", "shipping_zip", "shipping_country", "shipping_county"))
             + ", order_date timestamp_ntz, shipped_date timestamp_ntz, created_date timestamp_ntz, modified_date timestamp_ntz, "
             + ", ".join(f"{c} double" for c in ("total", "sub_total", "tax_total", "shipping_total", "bv_total", "cv_total", "discount_total")))

    def o(client, day, id_, user, total, ingest=None):
        return (*version(client, day, ingest), id_, user, None, 1, 1, 1, "c", *[None] * 9, day, None, day, None, float(total), *[0.0] * 6)

    item = ("id long, order_id long, product_id long, parent_product_id long, quantity long, "
            + ", ".join(f"{c} string" for c in ("product_code", "product_description", "tracking_number", "shipping_city", "shipping_state", "shipping_zip", "shipping_country", "shipping_county"))
            + ", " + ", ".join(f"{c} double" for c in ("price_each", "price_total", "weight_each", "weight_total", "tax", "bv", "bv_each", "cv", "cv_each")))

    def i(client, day, id_, order_id, code):
        return (*version(client, day), id_, order_id, 1, None, 1, code, *[None] * 7, *[1.0] * 9)

    return {
        "tree_users": frame(f"{V}, {user}",
                            u("north", "2019-01-01", 1, 1, 10, "11111"), u("north", "2019-02-01", 1, 1, 10, "22222"),
                            u("north", "2019-01-01", 2, None, None, "33333"), u("south", "2019-01-01", 1, 1, None, "44444")),
        "users": frame(f"{V}, id long, tree_user_id long", (*version("north", "2019-01-01"), 100, 1)),
        "tree_user_types": dimension(frame, "Distributor", "Customer"),
        "tree_user_statuses": dimension(frame, "Hold", "Deleted"),
        "tree_order_types": dimension(frame, "Web"),
        "tree_order_statuses": dimension(frame, "Shipped"),
        "pyr_rank_definitions": frame(f"{V}, id long, name string, level long", (*version("north", "2019-01-01"), 7, "Star", 10)),
        "tree_orders": frame(f"{V}, {order}", o("north", "2019-01-01", 1, 1, 5), o("north", "2019-01-01", 1, 1, 6, "2019-03-01"), o("south", "2019-01-01", 1, 1, 7), o("south", "2019-01-01", 2, 9, 8)),
        "tree_order_items": frame(f"{V}, {item}", i("north", "2019-01-01", 1, 1, "old"), i("north", "2019-02-01", 1, 1, "new"), i("north", "2019-02-01", 2, 1, "two")),
    }


def test_users_latest_complete_and_looked_up(lake, tenants):
    rows = refine.staging_users(lake, tenants, RULES, START, END).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["client"], r["zip"], r["user_id"], r["type"], r["status"]) == ("north", "22222", 100, "Distributor", "Active")
    assert (r["client_paid_rank"], r["client_lifetime_rank_level"], r["client_partition_id"]) == ("Star", 10, 2)


def test_personal_data_has_no_completeness_filter(lake, tenants):
    rows = refine.pii_users(lake, tenants, START, END).collect()
    assert {(r["client"], r["tree_user_id"], r["street"], r["gender"]) for r in rows} == {
        ("north", 1, "1 Road", "female"), ("north", 2, "1 Road", "female"), ("south", 1, "1 Road", "female"),
    }


def test_orders_later_ingest_wins_items_nested(lake, tenants):
    rows = {(r["client"], r["order_id"]): r for r in refine.staging_orders(lake, tenants, RULES, START, END).collect()}
    assert set(rows) == {("north", 1), ("south", 1), ("south", 2)}
    north = rows["north", 1]
    assert north["total"] == 6.0 and sorted(p["product_code"] for p in north["products"]) == ["new", "two"]
    assert (north["type"], north["status"], north["is_autoship"]) == ("Wholesale", "Active", False)
    assert rows["south", 1]["commission_user_id"] == 1 and rows["south", 1]["products"] is None
    assert "sponsor_id" not in north.asDict() and "client_user_type" not in north.asDict()


def test_order_type_is_found_through_the_buyer(lake, tenants):
    through = {r["order_id"]: r["client_type"] for r in refine.refined_orders(lake, tenants, START, END).filter("client = 'south'").collect()}
    own = {r["order_id"]: r["client_type"] for r in refine.refined_orders(lake, tenants, START, END, type_needs_user=False).filter("client = 'south'").collect()}
    assert through == {1: "Web", 2: None} and own == {1: "Web", 2: "Web"}


@pytest.fixture()
def contacts(frame):
    contact = ("id long, user_id long, tree_user_id long, contact_type long, level_of_interest long, first_name string, last_name string, birthday date,"
               " created_at timestamp_ntz, updated_at timestamp_ntz, is_downline_contact boolean, opt_in boolean, info string, avatar_file_name string,"
               " avatar_content_type string, avatar_file_size string, avatar_updated_at timestamp_ntz, address1 string, address2 string, city string,"
               " postal_code string, state string, country string")

    def c(client, day, id_, name, ingest=None, user_id=None):
        return (*version(client, day, ingest), id_, user_id, id_, 1, 1, name, "X", *[None] * 15, "XX")

    first = "2019-01-01"
    both = [("north", 1), ("north", 2), ("south", 1), ("south", 2)]
    return {
        "pyr_contacts": frame(f"{V}, {contact}", c("north", first, 1, "Ida"), c("north", first, 2, "Jan"), c("south", first, 1, "Kim"), c("south", first, 2, "Lea"),
                              c("south", "2019-02-01", 2, "Lea-2"), c("north", first, 1, "Ida-Replay", "2019-03-01 00:00:01")),
        "tree_users": frame(f"{V}, id long, sponsor_id long", *[(*version(a, first), b, 50 + b) for a, b in both if (a, b) != ("south", 2)]),
        "users": frame(f"{V}, id long, tree_user_id long", (*version("south", first), 9, 77)),
        "pyr_contact_categories": frame(f"{V}, id long, category_name string", (*version("north", first), 1, "One"), (*version("north", first), 2, "Two"),
                                        (*version("south", first), 1, "Uno"), (*version("north", "2020-01-01"), 1, "One-2020")),
        "pyr_contacts_contact_categories": frame(f"{V}, id long, contact_id long, contact_category_id long, created_at timestamp_ntz, updated_at timestamp_ntz",
                                                 *[(*version(a, first), i, b, 1, None, None) for i, (a, b) in enumerate(both)], (*version("north", "2019-04-01"), 9, 1, 2, None, None)),
        "pyr_contact_emails": frame(f"{V}, id long, contact_id long, email string, preferred boolean, undeliverable_count long, spam_reported_count long, source string",
                                    *[(*version(a, first), i, b, f"{a}{b}@example.com", None, None, None, None) for i, (a, b) in enumerate(both)],
                                    (*version("north", "2019-05-01", "2019-05-01 00:00:01"), 9, 1, "new@example.com", None, None, None, None)),
        "pyr_contact_phone_numbers": frame(f"{V}, id long, contact_id long, phone_number string, label string, unformatted_phone_number string, source string, dialing_code string",
                                           *[(*version(a, first), i, b, f"555-{i}", None, None, None, None) for i, (a, b) in enumerate(both)],
                                           (*version("north", "2019-06-01"), 9, 1, "555-9", None, None, None, None)),
    }


@pytest.mark.parametrize("first,last,count", [(START, "2019-01-01", 4), ("2019-01-01", "2019-02-01", 4), ("2019-03-01", "2019-03-01 12:00:00", 1), ("2019-05-01", "2019-05-01 12:00:00", 1)])
def test_contact_windows(contacts, tenants, first, last, count):
    assert refine.staging_contacts(contacts, tenants, first, last).count() == count


def test_replayed_contact_and_changed_mail(contacts, tenants):
    row = refine.staging_contacts(contacts, tenants, "2019-03-01", "2019-03-01 12:00:00").first()
    assert (row["client"], row["id"], row["first_name"]) == ("north", 1, "Ida-Replay")
    row = refine.staging_contacts(contacts, tenants, "2019-05-01", "2019-05-01 12:00:00").first()
    assert {e["email"] for e in row["emails"]} == {"north1@example.com", "new@example.com"}
    # phones without a plain number share one key: the newest stays; the newest link's category is named by its earliest event
    assert [p["phone_number"] for p in row["phone_numbers"]] == ["555-9"]
    assert [c["category"] for c in row["categories"]] == ["Two"]


def test_owner_of_members_and_of_plain_contacts(contacts, tenants):
    rows = {(r["client"], r["id"]): r for r in refine.staging_contacts(contacts, tenants, START, END).collect()}
    assert (rows["north", 1]["tree_user_id"], rows["north", 1]["owner_tree_user_id"]) == (1, 51)
    assert (rows["south", 2]["tree_user_id"], rows["south", 2]["owner_tree_user_id"]) == (None, None)


def test_contacts_without_a_child(contacts, tenants, frame):
    contacts["pyr_contact_emails"] = contacts["pyr_contact_emails"].filter("client = 'south'")
    assert refine.staging_contacts(contacts, tenants, START, END).filter("client = 'north'").count() == 0
    kept = refine.staging_contacts(contacts, tenants, START, END, how={"emails": "left"}).filter("client = 'north'").collect()
    assert len(kept) == 2 and all(r["emails"] is None for r in kept)


def test_crowded_contact_is_split_and_whole(contacts, tenants, frame):
    mails = contacts["pyr_contact_emails"]
    many = frame(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in mails.schema), *[(*version("south", "2019-01-02"), 100 + i, 1, f"m{i}@example.com", None, None, None, None) for i in range(40)])
    contacts["pyr_contact_emails"] = mails.unionByName(many)
    rows = refine.staging_contacts(contacts, tenants, START, END, child_limit=10).filter("client = 'south' AND id = 1").collect()
    assert len(rows) > 1 and sum(len(r["emails"]) for r in rows) == 41
    assert sum(len(r["phone_numbers"]) for r in rows) == 1


def test_items_of_changed_orders_are_picked_before_they_are_joined(spark, frame, tmp_path):
    tables = {
        "region": frame("r_regionkey int, r_name string", (0, "EUROPE"), (1, "ASIA")),
        "nation": frame("n_nationkey int, n_name string, n_regionkey int", (0, "A", 0), (1, "B", 1)),
        "customer": frame("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", (1, "c#1", 0, 1.0, "x"), (2, "c#2", 1, 1.0, "x"), (2, "c#2", 0, 1.0, "x")),
        "orders": frame("o_orderkey long, o_custkey long", (1, 1), (2, 2), (3, 2), (None, 1)),
        "part": frame("p_partkey long, p_name string, p_brand string, p_type string", (7, "n", "b", "t"), (8, None, "b", "t")),
        "lineitem": frame(
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
            *((o, p, 1, n, 2.0, 3.0, "N", "1996-01-02") for o in (1, 2, 3, None) for p in (7, 8, 9) for n in (1, 12))),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    star = Star(spark, str(tmp_path))
    lake = Lake(star)
    ids = frame("client string, order_id long", ("europe", 2), ("asia", 3), ("europe", 1), (None, 1), ("asia", None))
    picked, whole = lake.known("tree_order_items", "order_id", ids, "order_id"), history_of(star.lake_order_items(), ids, "order_id", "order_id")
    assert sorted(picked.columns) == sorted(whole.columns) and picked.count() == 12
    picked = picked.select(whole.columns)
    assert picked.exceptAll(whole).isEmpty() and whole.exceptAll(picked).isEmpty()
    assert lake.known("tree_orders", "id", ids, "order_id") is None
    # the long table is not written, as it would be moved whole
    assert "l_orderkey" in lake["tree_order_items"]._jdf.queryExecution().optimizedPlan().toString()


def test_items_are_moved_narrow_to_rank_their_versions_and_tenants_are_joined_to_orders_once(spark, frame, tmp_path):
    tables = {
        "region": frame("r_regionkey int, r_name string", (0, "EUROPE")),
        "nation": frame("n_nationkey int, n_name string, n_regionkey int", (0, "A", 0)),
        "customer": frame("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", (1, "c#1", 0, "x"), (2, "c#2", 0, "x")),
        "orders": frame(
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
            (1, 1, "F", 5.0, "1996-01-01", "5-LOW"), (2, 2, "O", 6.0, "1996-01-01", "5-LOW"), (2, 2, "O", 6.0, "1996-01-01", None)),
        "part": frame("p_partkey long, p_name string, p_brand string, p_type string", (7, "n", "b", "t"), (8, "m", "b", "t")),
        # order 1's line 12 and order 2's line 2 share an item id; the newest of its versions is of a part that is not there
        "lineitem": frame(
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
            (1, 7, 1, 12, 1.0, 3.0, "N", "1996-01-02"), (2, 8, 1, 2, 2.0, 3.0, "N", "1996-01-03"), (2, 9, 1, 2, 3.0, 3.0, "N", "1996-01-04"),
            (1, 7, 1, None, 4.0, 3.0, "N", "1996-01-05"), (2, 7, 1, None, 5.0, 3.0, "N", "1996-01-02")),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    star = Star(spark, str(tmp_path))
    lake = Lake(star)
    ids = frame("client string, order_id long", ("europe", 1), ("europe", 2))
    whole = latest_by(history_of(star.lake_order_items(), ids, "order_id", "order_id"), ["client", "id"])
    ranked = latest_by(lake.known("tree_order_items", "order_id", ids, "order_id"), ["client", "id"])
    found = {(r["id"], r["order_id"], r["quantity"]) for r in ranked.collect()}
    assert found == {(r["id"], r["order_id"], r["quantity"]) for r in whole.collect()} == {(22, 2, 2), (None, 1, 4)}
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    # read from the top: the version's name is made above the step that deals items out, which is the last to move them
    assert plan.index("date_format(") < plan.index("RepartitionByExpression") < plan.index("Join")
    # the tenant of an order is written with it, so no lake table of orders joins customers again
    for name in ("tree_orders", "tree_order_items", "pyr_contact_phone_numbers", "pyr_contacts_contact_categories"):
        assert "c_custkey" not in lake[name]._jdf.queryExecution().optimizedPlan().toString()
    assert lake["tree_orders"].count() == 4 and lake["pyr_contact_phone_numbers"].count() == 3
