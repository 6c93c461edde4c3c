"""Oracle SQL of assemblies, back-fill, updates and flat tables."""

from oracle.cohort import AS_OF
from oracle.refine import FIRST, USER_VIEWS, _latest, _users
from oracle.views import BASE, with_views

T = "europe"
N = "(SELECT count(*) FROM customer)"
RCP = f"""mr AS (SELECT conv_id AS message_id, (conv_id * 7 + turn) % {N} AS recipient_id,
  CASE role WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'PyrCrm::Contact' ELSE 'PyrTree::User' END AS recipient_type,
  CASE WHEN (conv_id + turn) % 5 > 0 THEN 'email' ELSE 'sms' END AS delivery_type, turn AS opened_count FROM conversations),
us AS (SELECT c_custkey AS id, c_custkey + 5000000 AS tree_user_id FROM customer),
co AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 > 0 THEN c_custkey + 9000000 END AS tree_user_id FROM customer)"""
RJOIN = """LEFT JOIN customer tu ON mr.recipient_type = 'PyrTree::User' AND mr.recipient_id = tu.c_custkey
LEFT JOIN co ON mr.recipient_type = 'PyrCrm::Contact' AND mr.recipient_id = co.id LEFT JOIN us ON mr.recipient_type = 'User' AND mr.recipient_id = us.id"""
RID = "CASE WHEN tu.c_custkey IS NOT NULL THEN tu.c_custkey WHEN co.id IS NOT NULL THEN co.tree_user_id WHEN us.id IS NOT NULL THEN us.tree_user_id END"
MSG = f"""mm AS (SELECT conv_id AS id, conv_id % {N} AS sender_id, CASE WHEN conv_id % 2 = 0 THEN 'User' ELSE 'PyrCrm::Contact' END AS sender_type,
  'subject ' || conv_id AS subject, {BASE} + to_days(CAST(conv_id % 400 AS INTEGER)) AS created_at FROM conversations GROUP BY conv_id)"""
SENDER = "CASE WHEN sender_type = 'User' THEN sender_id + 5000000 WHEN sender_id % 3 > 0 THEN sender_id + 9000000 END"


def polymorphic_lookup() -> str:
    return f"WITH {RCP} SELECT message_id, recipient_id, recipient_type, opened_count, {RID} AS recipient_tree_user_id FROM mr {RJOIN}"


def staging_emails() -> str:
    return with_views(["clients"], f"""WITH {RCP}, {MSG},
r AS (SELECT message_id, count(*) AS n, string_agg(coalesce(CAST(t AS VARCHAR), '-'), ',' ORDER BY t NULLS FIRST) AS who
  FROM (SELECT mr.*, {RID} AS t FROM mr {RJOIN} WHERE delivery_type = 'email') GROUP BY 1)
SELECT client, partition_id AS client_partition_id, mm.id AS message_id, {SENDER} AS sender_tree_user_id, subject, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS message_created_at,
  coalesce(n, 1) AS recipients, coalesce(who, '-') AS who FROM mm LEFT JOIN r ON mm.id = r.message_id JOIN clients ON client = '{T}'""")


def flat_emails() -> str:
    return f"""WITH {RCP}, {MSG}
SELECT mm.id AS message_id, {SENDER} AS message_tree_user_id, {RID} AS recipient_tree_user_id, recipient_type, opened_count, subject
FROM mm LEFT JOIN mr ON mm.id = mr.message_id AND delivery_type = 'email' {RJOIN}"""


def staging_links() -> str:
    return with_views(["u"], f"""
SELECT page_id AS link_id, page_id % {N} AS link_sharer_id, strftime({BASE} + to_days(CAST(page_id % 300 AS INTEGER)), '%Y-%m-%d %H:%M:%S.%f') AS created_at,
  CASE WHEN page_id % 3 > 0 THEN 'PyrCore::ResourceAsset' ELSE 'PyrCrm::Ecard' END AS asset_type, d.source AS title, d.lang AS file_type,
  CAST(d.doc_id % 2 AS BOOLEAN) AS can_email, d.n_chars AS likes, labels.doc_id AS resource_id, 'quality ' || labels.quality AS resource_title
FROM pages JOIN u ON u.user_id = page_id % {N} AND u.client = '{T}' LEFT JOIN documents d ON d.doc_id = page_id AND page_id % 3 > 0
LEFT JOIN labels ON labels.doc_id = d.doc_id""")


def site_visitors() -> str:
    f = "'%Y-%m-%d %H:%M:%S.%f'"
    return f"""
SELECT '{T}' AS client, s_suppkey AS site_id, c.c_custkey AS user_id, c.c_custkey * 2 AS tree_user_id, e.event_id AS visitor_id, strftime(e.ts, {f}) AS last_visit_date,
  CAST(trunc(e.value) AS BIGINT) AS visit_count, CASE WHEN e.event_id IS NOT NULL THEN '127.0.0.1' END AS ipaddress, e.props AS browser_agent, strftime(e.ts, {f}) AS created_at,
  k.c_mktsegment AS third_party_tracking_company, k.c_name AS tracking_code
FROM supplier JOIN customer c ON c.c_custkey = TRY_CAST(CASE WHEN s_suppkey % 11 > 0 THEN CAST(s_suppkey AS VARCHAR) ELSE 'none' END AS BIGINT)
LEFT JOIN events e ON e.event_type = 'view' AND (e.user_id * 2) % (SELECT count(*) FROM supplier) = s_suppkey
LEFT JOIN customer k ON k.c_custkey = c.c_custkey AND k.c_custkey % 2 = 0"""


VISITS = f"""si AS (SELECT s_suppkey AS site_id, c.c_custkey AS user_id, c.c_custkey * 2 AS tree_user_id,
    CASE WHEN s_suppkey % 5 > 0 THEN {BASE} + to_days(CAST(s_suppkey % 400 AS INTEGER)) END AS created_at
  FROM supplier JOIN customer c ON c.c_custkey = TRY_CAST(CASE WHEN s_suppkey % 11 > 0 THEN CAST(s_suppkey AS VARCHAR) ELSE 'none' END AS BIGINT)),
vi AS (SELECT (user_id * 2) % (SELECT count(*) FROM supplier) AS site_id, count(*) AS visitors, CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS visits
  FROM events WHERE event_type = 'view' GROUP BY 1)"""


def staging_sites() -> str:
    return with_views(["clients"], f"""WITH {VISITS}
SELECT cl.client, cl.partition_id AS client_partition_id, si.site_id, user_id, tree_user_id, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
  coalesce(visitors, 0) AS visitors, CASE WHEN visitors IS NULL AND user_id % 2 = 1 THEN NULL ELSE coalesce(visits, 0) END AS visits,
  CASE WHEN user_id % 2 = 0 THEN k.c_name WHEN visitors IS NOT NULL THEN '' END AS codes
FROM si LEFT JOIN vi USING (site_id) LEFT JOIN customer k ON k.c_custkey = user_id JOIN clients cl ON cl.client = '{T}'""")


def tasks() -> str:
    return """
SELECT doc_id AS id, md5(text) AS task_title, lang AS description, '1996-01-01 00:00:00.000000' AS due_date, doc_id * 3 AS user_id, c_custkey + 1 AS tree_user_id,
  CASE WHEN source = 'src1' THEN 1 ELSE 0 END AS from_system, n_chars % 5 AS priority, '1995-06-01 00:00:00.000000' AS created_at, NULL AS completed_at
FROM documents JOIN customer ON c_custkey = doc_id * 3 WHERE text NOT ILIKE '%test%'"""


def backfill_users() -> str:
    return with_views(USER_VIEWS, f"""WITH t AS {_latest('lk_tree_users', 'client, id')}, ty AS {_latest('lk_user_types', 'client, id')}, st AS {_latest('lk_user_statuses', 'client, id')}
SELECT c.partition_id AS client_partition_id, c.partner_id AS client_partner_id, t.client, 'z/0' AS event_id, t.id AS tree_user_id, u.id AS user_id, sponsor_id, parent_id,
  CASE WHEN ty.description LIKE '%Customer%' OR ty.description = 'Employee' THEN 'Autoship' ELSE 'Distributor' END AS type,
  CASE WHEN st.description IN ('Active', 'Grace', 'Hold') THEN 'Active' ELSE 'Inactive' END AS status, ty.description AS client_type, zip,
  strftime(coded_date, '%Y-%m-%d %H:%M:%S.%f') AS coded, strftime(created_date, '%Y-%m-%d %H:%M:%S.%f') AS created, st.description AS client_status, strftime(updated_date, '%Y-%m-%d %H:%M:%S.%f') AS modified
FROM t JOIN ty ON t.client = ty.client AND t.user_type_id = ty.id JOIN st ON t.client = st.client AND t.user_status_id = st.id
LEFT JOIN lk_users u ON u.client = t.client AND u.tree_user_id = t.id JOIN clients c ON c.client = t.client WHERE t.client = '{T}'""")


def member_types_update() -> str:
    return with_views(["u"], f"""
SELECT client, tree_user_id, CASE WHEN tree_user_id % 3 = 0 THEN 'Kept' WHEN client <> '{T}' THEN 'tbd'
    ELSE CASE tree_user_id % 5 WHEN 0 THEN 'Distributor' WHEN 1 THEN 'Customer' WHEN 2 THEN 'Distributor' WHEN 3 THEN 'Autoship' END END AS type,
  CASE WHEN client = '{T}' THEN client_type ELSE 'tbd' END AS status,
  CASE tree_user_id % 5 WHEN 0 THEN 'MEMBER' WHEN 1 THEN 'RETAIL' WHEN 2 THEN 'BA' WHEN 3 THEN 'PC' ELSE 'other' END AS client_type, client_type AS client_status
FROM u""")


OWNER = "CASE WHEN {u}.type <> 'Distributor' OR {u}.coded > {d} THEN {u}.sponsor_id ELSE {u}.tree_user_id END"
OTYPE = "CASE WHEN {u}.type = 'Distributor' AND {u}.coded <= {d} THEN 'Wholesale' WHEN {u}.type = 'Distributor' THEN 'Autoship' WHEN {u}.type = 'Customer' THEN 'Retail' END"


def backfill_orders() -> str:
    return with_views(["u", "lk_orders", "lk_items", "lk_order_types", "lk_order_statuses"], f"""WITH oo AS {_latest('lk_orders', 'client, id')}, it AS {_latest('lk_items', 'client, id')},
ty AS {_latest('lk_order_types', 'client, id')}, st AS {_latest('lk_order_statuses', 'client, id')}, n AS (SELECT order_id, count(*) AS n FROM it GROUP BY 1)
SELECT u.client, oo.id AS order_id, {OWNER.format(u='u', d='oo.order_date')} AS commission_user_id, u.tree_user_id, {OTYPE.format(u='u', d='oo.order_date')} AS type,
  CASE WHEN st.description IN ('ACH Declined', 'Cancelled', 'CC Declined') THEN 'Inactive' ELSE 'Active' END AS status, ty.description AS client_type, st.description AS client_status,
  coalesce(autoship_template_id > 0, FALSE) AS is_autoship, CAST(total AS DOUBLE) AS total, coalesce(n.n, 0) AS products
FROM oo JOIN u ON u.tree_user_id = oo.tree_user_id AND u.client = '{T}' JOIN ty ON ty.client = '{T}' AND ty.id = oo.order_type_id
JOIN st ON st.client = '{T}' AND st.id = oo.order_status_id LEFT JOIN n ON n.order_id = oo.id""")


def orders_from_users_update() -> str:
    return with_views(["u", "o"], f"""
SELECT u.client, order_id, o.tree_user_id, CASE WHEN u.client = '{T}' THEN {OWNER.format(u='u', d='o.order_date')} ELSE commission_user_id END AS commission_user_id,
  CASE WHEN u.client = '{T}' THEN {OTYPE.format(u='u', d='o.order_date')} ELSE o.type END AS type, strftime(order_date, '%Y-%m-%d %H:%M:%S.%f') AS order_date
FROM o JOIN u ON o.tree_user_id = u.tree_user_id""")


def order_codes() -> str:
    return """SELECT code, CASE code WHEN 'B' THEN 'Backorder Cancelled' WHEN 'C' THEN 'Credit/RMA' WHEN 'D' THEN 'Retail' WHEN 'E' THEN 'Exchange/RMA'
  WHEN 'I' THEN 'Wholesale' WHEN 'R' THEN 'Replacement' WHEN 'X' THEN 'Exchange/Order' WHEN 'Y' THEN 'Point Redemption' END AS type, count(*) AS n
FROM (SELECT substr('BCDEIRXYZ', CAST(l_partkey % 9 + 1 AS INTEGER), 1) AS code FROM lineitem) GROUP BY 1, 2"""


def backfill_pii() -> str:
    return with_views(["lk_tree_users", "clients"], f"""
SELECT c.partition_id AS client_partition_id, c.partner_id AS client_partner_id, t.client, 'z/0' AS event_id, id AS tree_user_id, first_name, last_name, company_name,
  address1 || CASE WHEN address2 <> '' THEN ' ' || address2 ELSE '' END AS street, city, state, country, email, phone, mobile_phone,
  CASE gender WHEN 'F' THEN 'female' WHEN 'male' THEN 'male' ELSE 'none' END AS gender, CAST(birth_date AS VARCHAR) AS birth_date
FROM {_latest('lk_tree_users', 'client, id')} t JOIN clients c USING (client) WHERE t.client = '{T}'""")


COMM = """ea AS (SELECT o_custkey AS tree_user_id, year(o_orderdate) * 100 + month(o_orderdate) AS run, sum(CAST(o_totalprice AS DECIMAL(19,4))) AS earnings,
    min(date_trunc('month', o_orderdate)) AS run_date, min(year(o_orderdate) * 10 + quarter(o_orderdate)) AS period_id, min(quarter(o_orderdate) % 2 + 1) AS kind,
    min(year(o_orderdate) || '-Q' || quarter(o_orderdate)) AS period FROM orders GROUP BY 1, 2)"""


def commissions() -> str:
    return f"""WITH {COMM}
SELECT tree_user_id, run AS run_id, CAST(CAST(run_date AS DATE) AS VARCHAR) AS run_date, period_id, kind AS period_type_id, period, r_name AS period_type, 'USD' AS currency_code, CAST(earnings AS DOUBLE) AS earnings
FROM ea JOIN region ON r_regionkey + 1 = kind JOIN customer ON c_custkey = tree_user_id"""


def commissions_nested() -> str:
    return f"""WITH {COMM} SELECT tree_user_id, count(*) AS runs, CAST(sum(earnings) AS DOUBLE) AS earnings, min(run) AS first_run FROM ea GROUP BY 1"""


def order_items_flat() -> str:
    return with_views(["lk_orders", "lk_items", "lk_order_types", "lk_order_statuses"], f"""WITH oo AS {_latest('lk_orders', 'client, id')},
it AS {_latest('lk_items JOIN (SELECT l_orderkey * 10 + l_linenumber AS i2, l_returnflag, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM lineitem) x ON x.i2 = lk_items.id AND x.l_partkey = product_id AND x.l_shipdate = ingested_at AND CAST(x.l_extendedprice AS DECIMAL(19,4)) = price_total', 'client, id')},
ty AS {_latest('lk_order_types', 'client, id')}, st AS {_latest('lk_order_statuses', 'client, id')}
SELECT oo.id AS order_id, it.id AS order_item_id, oo.tree_user_id, ty.description AS type, st.description AS status, CASE WHEN autoship_template_id > 0 THEN 1 ELSE 0 END AS is_autoship,
  CAST(total AS DOUBLE) AS total, product_id, product_code, quantity, CAST(price_total AS DOUBLE) AS price_total, l_returnflag AS item_tracking_number, client_user_id
FROM oo JOIN it ON it.order_id = oo.id JOIN ty ON ty.client = '{T}' AND ty.id = order_type_id JOIN st ON st.client = '{T}' AND st.id = order_status_id""")


def demographics() -> str:
    return with_views(USER_VIEWS, f"""WITH t AS {_latest('lk_tree_users', 'client, id')}, ty AS {_latest('lk_user_types', 'client, id')}, st AS {_latest('lk_user_statuses', 'client, id')}
SELECT t.id AS tree_user_id, u.id AS user_id, sponsor_id, parent_id, ty.description AS type, city, state, zip, country, gender,
  date_sub('year', CAST(birth_date AS TIMESTAMP), TIMESTAMP '{AS_OF}') AS age, strftime(created_date, '%Y-%m-%d %H:%M:%S.%f') AS signup_date, st.description AS status,
  strftime(updated_date, '%Y-%m-%d %H:%M:%S.%f') AS last_modified
FROM t JOIN ty ON t.client = ty.client AND t.user_type_id = ty.id JOIN st ON t.client = st.client AND t.user_status_id = st.id LEFT JOIN lk_users u ON u.tree_user_id = t.id WHERE t.client = '{T}'""")


def product_reviews() -> str:
    f = "'%Y-%m-%d %H:%M:%S.%f'"
    base = "TIMESTAMP '1996-01-01'"
    return f"""
SELECT p_brand || '-' || p_partkey AS product_code, p_name AS product_name, p_type AS product_description, p_brand AS product_short_description, '1995-01-01 00:00:00.000000' AS product_available_on,
  NULL AS product_discontinue_on, replace(p_name, ' ', '-') AS product_slug, CAST(p_size % 6 AS DOUBLE) AS product_avg_rating, p_size AS product_reviews_count, 'reviewer ' || doc_id AS review_name,
  lang AS location, 1 + n_chars % 5 AS rating, source AS title, md5(text) AS review, doc_id % 2 = 0 AS approved, strftime({base} + to_days(CAST(doc_id % 700 AS INTEGER)), {f}) AS created_at,
  strftime({base} + to_days(CAST(doc_id % 900 AS INTEGER)), {f}) AS updated_at, doc_id AS user_id, '127.0.0.1' AS ip_address, lang AS locale, TRUE AS show_identifier, c_custkey + 7 AS tree_user_id
FROM documents JOIN customer ON c_custkey = doc_id JOIN part ON p_partkey = doc_id * 3"""


def upsert_by_key() -> str:
    split = "TIMESTAMP '1999-01-01'"
    return with_views(["lk_items"], f"""WITH a AS {_latest('lk_items', 'client, id', where=f'ingested_at < {split}')}, b AS {_latest('lk_items', 'client, id', where=f'ingested_at >= {split}')},
r AS (SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.client = a.client AND b.id = a.id))
SELECT client, id, event_id, strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at, product_id, quantity FROM r""")


def next_window() -> str:
    return with_views(["lk_orders", "lk_items"], f"""WITH p AS (SELECT ingested_at, 'tree_orders' AS tbl FROM lk_orders WHERE ingested_at >= TIMESTAMP '{FIRST}'
  UNION SELECT ingested_at, 'tree_order_items' FROM lk_items WHERE ingested_at >= TIMESTAMP '{FIRST}')
SELECT '{FIRST}' AS first, strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S.%f') AS last, max(ingested_at) IS NOT NULL AS has_data FROM p""")


def key_range_read() -> str:
    return "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"


def filtered_export_source() -> str:
    return with_views(USER_VIEWS, f"""WITH {_users(AS_OF).replace('t.event_id', 't.event_id, t.ingested_at, t.created_date', 1)}
SELECT client, tree_user_id, strftime(created_date, '%Y-%m-%d %H:%M:%S.%f') AS created, d AS client_type, strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at
FROM r WHERE ingested_at BETWEEN TIMESTAMP '{FIRST}' AND TIMESTAMP '{AS_OF}' AND tree_user_id % 2 = 0 AND created_date >= TIMESTAMP '1995-06-01'""")


def text_key_join() -> str:
    return "SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 10 > 0 GROUP BY 1"


def rank_fan_out() -> str:
    return with_views(["lk_ranks"], "SELECT level, count(*) AS copies FROM lk_ranks GROUP BY 1 HAVING count(*) > 1")
