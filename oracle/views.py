"""SQL definitions of the derived tables, for the oracle queries."""

VIEWS: dict[str, tuple[list[str], str]] = {}


def view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name] = (list(needs), sql)


def with_views(names: list[str], body: str, recursive: bool = False) -> str:
    """``WITH`` clause of the named views and all they need, then the body."""
    done: list[str] = []

    def add(name: str) -> None:
        for need in VIEWS[name][0]:
            add(need)
        if name not in done:
            done.append(name)

    for name in names:
        add(name)
    clauses = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in done)
    body = body.strip()
    start = "WITH RECURSIVE" if recursive else "WITH"
    if body[:4].upper() == "WITH" and body[4].isspace():
        return f"{start} {clauses},\n{body[5:]}"
    return f"{start} {clauses}\n{body}"


BASE = "TIMESTAMP '1995-01-01 00:00:00'"

view("place", "SELECT n_nationkey, n_name, r_name, lower(r_name) AS client FROM nation JOIN region ON n_regionkey = r_regionkey")
view("cust", "SELECT * FROM customer JOIN place ON c_nationkey = n_nationkey", "place")
view("u", f"""
SELECT c_custkey AS tree_user_id, c_custkey AS user_id,
  CASE WHEN c_custkey > 0 THEN c_custkey // 10 END AS sponsor_id,
  {BASE} + to_days(CAST(c_custkey % 730 AS INTEGER)) AS created,
  {BASE} + to_days(CAST(c_custkey % 730 AS INTEGER)) AS coded,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'Distributor' ELSE 'Customer' END AS type,
  c_mktsegment AS client_type, client, n_name AS country
FROM cust""", "cust")
view("o", """
SELECT o_orderkey AS order_id, o_custkey AS commission_user_id,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE (o_custkey + 1) % (SELECT count(*) FROM customer) END AS tree_user_id,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Retail'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'Wholesale' ELSE 'Autoship' END AS type,
  o_orderpriority = '5-LOW' AS is_autoship,
  CASE WHEN o_orderstatus = 'P' THEN 'Cancelled' ELSE 'Active' END AS status,
  CAST(o_totalprice AS DECIMAL(19,4)) AS total,
  CAST(o_orderkey % 100 AS DECIMAL(19,4)) AS bv_total,
  CAST(o_custkey % 50 AS DECIMAL(19,4)) AS cv_total,
  o_orderdate AS order_date
FROM orders""")
view("li", """
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, l_suppkey AS supplier_id,
  CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(19,4)) AS price_total, l_shipdate AS shipped
FROM lineitem""")
view("items", """
SELECT li.order_id, o.tree_user_id, o.status, o.order_date, p_name || ' ' || CASE p_type WHEN 'ECONOMY' THEN 'Monthly RBS'
    WHEN 'PROMO' THEN 'Get4Discount DTP' WHEN 'STANDARD' THEN 'Reactivation DT Gold' WHEN 'MEDIUM' THEN 'Preview Event'
    WHEN 'SMALL' THEN 'Pick Your Product' ELSE 'College month WVA' END AS product_description, li.price_total, li.product_id
FROM li JOIN o ON li.order_id = o.order_id JOIN part ON p_partkey = li.product_id""", "li", "o")
view("logins", """
SELECT event_id AS id, user_id,
  CASE WHEN event_type = 'error' THEN NULL
    WHEN event_id % 10 = 0 THEN 'Linux x86' WHEN event_id % 10 = 1 THEN 'ChromeOS'
    WHEN event_id % 10 = 2 THEN 'Fedora' WHEN event_id % 10 = 3 THEN 'Windows Phone'
    WHEN event_type = 'click' THEN 'Android 9' WHEN event_type = 'view' THEN 'Windows'
    WHEN event_type = 'purchase' THEN 'iPhone' ELSE 'Intel Mac OS X 10' END AS platform,
  ts - INTERVAL 29 YEARS AS created_at,
  CASE WHEN event_id % 7 = 0 THEN user_id END AS proxied_by_id
FROM events""")
view("turns", f"""
SELECT *,
  CASE WHEN turn > 1 THEN created + to_days(CAST(turn AS INTEGER)) END AS seen,
  CASE WHEN turn > 2 THEN created + to_days(CAST(turn * 2 AS INTEGER)) END AS read,
  CASE WHEN turn % 4 = 3 THEN created END AS undeliverable
FROM (SELECT conv_id % (SELECT count(*) FROM customer) AS sender_tree_user_id, conv_id AS message_id,
    {BASE} + to_days(CAST((conv_id * 3) % 400 AS INTEGER)) AS created,
    {BASE} + to_hours(CAST(((conv_id * 3) % 400) * 24 + conv_id % 48 AS INTEGER)) AS sent, turn
  FROM conversations)""")
view("upline", """
SELECT c_custkey AS tree_user_id, c_custkey // CAST(pow(10, d) AS BIGINT) AS upline_id
FROM (SELECT c_custkey, unnest(range(1, length(CAST(c_custkey AS VARCHAR)) + 1)) AS d FROM customer WHERE c_custkey > 0)""")

EVENT_OF_ORDER = "'z/' || strftime(o_orderdate, '%Y/%m/%d/%H/%M') || '/' || lpad(CAST(o_orderkey AS VARCHAR), 13, '0') || '-0000000'"


def _described(name: str, words: list[str], stale: str = "stale") -> None:
    cases = " ".join(f"WHEN {i + 1} THEN '{w}'" for i, w in enumerate(words))
    view(name, f"""
SELECT client, 'z/' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS event_id, {BASE} + to_hours(n_nationkey) AS ingested_at,
  CAST(i AS BIGINT) AS id, CASE WHEN n_nationkey >= 20 THEN CASE i {cases} END ELSE '{stale}' END AS description
FROM place, range(1, {len(words) + 1}) AS r(i)""", "place")


_described("lk_user_types", ["Distributor", "Pending Transfer", "MarketPlace Customer", "Employee", "B2B"])
_described("lk_user_statuses", ["Active", "Hold", "Terminated"])
_described("lk_order_types", ["Shopping Cart", "Web Wizard", "Import", "API Order", "Recurring Order"])
_described("lk_order_statuses", ["Cancelled", "Shipped", "CC Declined"])
_described("lk_categories", ["Friend", "Family", "Work"], "first name")
view("lk_ranks", f"SELECT client, 'z/0' AS event_id, {BASE} AS ingested_at, n_nationkey AS id, n_name AS name, (n_nationkey // 5) * 10 AS level FROM place", "place")
view("lk_tree_users", f"""
SELECT client, {EVENT_OF_ORDER} AS event_id, o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS ingested_at, c_custkey AS id,
  CASE WHEN c_custkey > 0 THEN c_custkey // 10 END AS sponsor_id, CASE WHEN c_custkey > 0 THEN c_custkey // 10 END AS parent_id,
  CASE WHEN o_orderkey % 97 > 0 THEN CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END END AS user_type_id,
  CASE o_orderstatus WHEN 'P' THEN 3 WHEN 'O' THEN 1 ELSE 2 END AS user_status_id,
  CASE WHEN o_orderkey % 89 > 0 THEN (c_custkey % 5) * 10 END AS rank_id, (c_nationkey // 5) * 10 AS paid_rank_id,
  lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS zip,
  {BASE} + to_days(CAST(c_custkey % 730 AS INTEGER)) AS created_date, o_orderdate AS updated_date,
  {BASE} + to_days(CAST(c_custkey % 730 AS INTEGER)) AS coded_date,
  split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name, c_mktsegment AS company_name, n_name AS address1,
  CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'Suite ' || o_orderkey END AS address2,
  r_name AS city, o_orderstatus AS state, n_name AS country, c_custkey || '@example.com' AS email, '555-' || o_orderkey AS phone,
  '' AS mobile_phone, CASE o_orderkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'male' WHEN 2 THEN 'x' END AS gender,
  DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS birth_date
FROM cust JOIN orders ON c_custkey = o_custkey""", "cust")
view("lk_users", f"SELECT client, 'z/0' AS event_id, {BASE} + to_days(CAST(c_custkey % 730 AS INTEGER)) AS ingested_at, c_custkey + 1000000 AS id, c_custkey AS tree_user_id FROM cust", "cust")
view("ot", "SELECT orders.*, client FROM orders JOIN cust ON o_custkey = c_custkey", "cust")
view("lk_orders", f"""
SELECT client, {EVENT_OF_ORDER} AS event_id, o_orderdate + to_days(v) AS ingested_at, o_orderkey AS id,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE (o_custkey + 1) % (SELECT count(*) FROM customer) END AS tree_user_id,
  CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0 END AS autoship_template_id,
  CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS order_status_id,
  CAST(o_orderpriority[1] AS INTEGER) AS order_type_id, o_orderkey + 7 AS client_order_id, CAST(o_custkey AS VARCHAR) AS client_user_id,
  o_orderdate AS order_date, o_orderdate - to_days(CAST(o_orderkey % 2 AS INTEGER)) AS created_date,
  CAST(o_totalprice + v AS DECIMAL(19,4)) AS total
FROM ot, range(0, 2) AS r(v0), LATERAL (SELECT CAST(v0 AS INTEGER) AS v) WHERE v = 0 OR o_orderstatus = 'F'""", "ot")
view("lk_items", """
SELECT client, 'z/' || strftime(l_shipdate, '%Y/%m/%d/%H/%M') || '/' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0')
    || '-' || lpad(CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS VARCHAR), 20, '0') AS event_id,
  l_shipdate AS ingested_at, l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS product_id, p_brand AS product_code,
  p_name || ' ' || p_type AS product_description, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(19,4)) AS price_total
FROM lineitem JOIN ot ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""", "ot")
view("lk_contacts", f"""
SELECT client, 'z/1995/' || lpad(CAST(c_custkey % 730 + v AS VARCHAR), 4, '0') AS event_id,
  {BASE} + to_days(CAST(c_custkey % 730 + v * 30 AS INTEGER)) AS ingested_at, c_custkey AS id, c_custkey // 7 + 1000000 AS user_id,
  CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS tree_user_id, c_custkey % 3 AS contact_type,
  split_part(c_name, '#', 2) || '-' || v AS last_name, n_name AS address1
FROM cust, range(0, 2) AS r(v)""", "cust")
view("lk_emails", """
SELECT client, 'z/' || lpad(CAST(event_id AS VARCHAR), 13, '0') AS event_id, ts - INTERVAL 29 YEARS AS ingested_at, events.event_id AS id,
  user_id AS contact_id, event_type || user_id || '@example.com' AS email, event_type AS source, value > 5 AS preferred,
  events.event_id % 3 AS undeliverable_count
FROM events JOIN cust ON user_id = c_custkey""", "cust")
view("lk_phones", """
SELECT client, 'z/' || lpad(CAST(o_orderkey AS VARCHAR), 13, '0') AS event_id, o_orderdate AS ingested_at, o_orderkey AS id, o_custkey AS contact_id,
  '555-' || o_orderkey AS phone_number, '555' || o_orderpriority[1] AS unformatted_phone_number FROM ot""", "ot")
view("lk_links", """
SELECT client, 'z/' || lpad(CAST(o_orderkey AS VARCHAR), 13, '0') AS event_id, o_orderdate AS ingested_at, o_orderkey AS id, o_custkey AS contact_id,
  CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS contact_category_id, o_orderdate AS created_at FROM ot""", "ot")
view("clients", "SELECT lower(r_name) AS client, r_regionkey + 1 AS partition_id, 'p-' || lower(r_name) AS partner_id FROM region WHERE r_name <> 'ASIA'")
