"""Oracle SQL of the lake operators and refine jobs."""

from oracle.views import with_views

FIRST, LAST = "1996-01-01", "1996-12-31"


def _between(last: str = LAST) -> str:
    return f"ingested_at BETWEEN TIMESTAMP '{FIRST}' AND TIMESTAMP '{last}'"


def _latest(table: str, keys: str, order: str = "event_id DESC, ingested_at DESC", where: str = "TRUE") -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {table} WHERE {where}) WHERE rn = 1)"


def latest_version() -> str:
    return with_views(["lk_items"], f"""
SELECT client, id, event_id, order_id, product_id, quantity, CAST(price_total AS DOUBLE) AS price_total FROM {_latest('lk_items', 'client, id')}""")


def latest_version_mixed_order() -> str:
    return with_views(["lk_categories"], f"""
SELECT client, id, event_id, description AS category_name FROM {_latest('lk_categories', 'client, id', 'event_id ASC, ingested_at DESC')}""")


def window(low: str) -> str:
    return with_views(["lk_tree_users"], f"""
SELECT client, count(*) AS n, CAST(min(event_id) AS VARCHAR) AS first_event, max(event_id) AS last_event FROM lk_tree_users
WHERE ingested_at {low} TIMESTAMP '{FIRST}' AND ingested_at <= TIMESTAMP '{LAST}' GROUP BY 1""")


def changed_ids() -> str:
    return with_views(["lk_orders", "lk_items"], f"""
SELECT client, id AS order_id FROM lk_orders WHERE {_between()} UNION SELECT client, order_id FROM lk_items WHERE {_between()}""")


TYPE = """CASE WHEN lower(d) LIKE '%transfer%' THEN 'Distributor' WHEN lower(d) LIKE '%customer%' THEN 'Autoship'
  WHEN lower(d) = 'employee' THEN 'Autoship' WHEN lower(d) IN ('b2b', 'distributor') THEN 'Distributor' END"""


def _users(last: str = LAST) -> str:
    return f"""ids AS (SELECT client, id FROM lk_tree_users WHERE {_between(last)} UNION SELECT client, tree_user_id FROM lk_users WHERE {_between(last)}),
t AS {_latest('lk_tree_users', 'client, id')},
ty AS {_latest('lk_user_types', 'client, id')}, st AS {_latest('lk_user_statuses', 'client, id')},
r AS (SELECT c.partition_id AS client_partition_id, c.partner_id AS client_partner_id, t.client, t.id AS tree_user_id, u.id AS user_id, t.sponsor_id, t.zip, t.updated_date AS modified,
  ty.description AS d, st.description AS client_status, p.name AS client_paid_rank, p.level AS client_paid_rank_level, l.name AS client_lifetime_rank, l.level AS client_lifetime_rank_level, t.event_id
FROM t JOIN ids USING (client, id) JOIN clients c USING (client)
LEFT JOIN lk_users u ON u.client = t.client AND u.tree_user_id = t.id
LEFT JOIN ty ON ty.client = t.client AND ty.id = t.user_type_id LEFT JOIN st ON st.client = t.client AND st.id = t.user_status_id
LEFT JOIN lk_ranks p ON p.client = t.client AND p.level = t.paid_rank_id LEFT JOIN lk_ranks l ON l.client = t.client AND l.level = t.rank_id
WHERE t.sponsor_id IS NOT NULL AND t.user_type_id IS NOT NULL AND t.rank_id IS NOT NULL)"""


USER_VIEWS = ["lk_tree_users", "lk_users", "lk_user_types", "lk_user_statuses", "lk_ranks", "clients"]


def staging_users() -> str:
    return with_views(USER_VIEWS, f"""WITH {_users()}
SELECT client_partition_id, client_partner_id, client, tree_user_id, user_id, sponsor_id, zip, strftime(modified, '%Y-%m-%d %H:%M:%S.%f') AS modified, d AS client_type, client_status,
  client_paid_rank, client_paid_rank_level, client_lifetime_rank, client_lifetime_rank_level, event_id,
  CASE WHEN client = 'america' THEN d ELSE {TYPE} END AS type,
  CASE WHEN client = 'america' THEN NULL WHEN lower(client_status) IN ('active', 'grace', 'hold') THEN 'Active' ELSE 'Inactive' END AS status
FROM r WHERE client IN ('america', 'europe', 'africa')""")


def staging_orders() -> str:
    return with_views(["lk_orders", "lk_items", "lk_tree_users", "lk_user_types", "lk_order_types", "lk_order_statuses", "clients"], f"""WITH
ids AS (SELECT client, id FROM lk_orders WHERE {_between()} UNION SELECT client, order_id FROM lk_items WHERE {_between()}),
oo AS {_latest('lk_orders', 'client, id')}, it AS {_latest('lk_items', 'client, id')}, tu AS {_latest('lk_tree_users', 'client, id')},
ty AS {_latest('lk_user_types', 'client, id')}, ot2 AS {_latest('lk_order_types', 'client, id')}, os AS {_latest('lk_order_statuses', 'client, id')},
pr AS (SELECT client, order_id, count(*) AS n, sum(price_total) AS items_total,
    string_agg(product_code || ':' || quantity, ',' ORDER BY product_id, product_code, product_description, quantity, price_total) AS codes FROM it GROUP BY 1, 2),
r AS (SELECT c.partition_id AS client_partition_id, oo.client, oo.id AS order_id, tu.id AS tree_user_id, tu.sponsor_id, ty.description AS d,
  CASE WHEN tu.id IS NOT NULL THEN ot2.description END AS client_type, os.description AS client_status, coalesce(autoship_template_id > 0, FALSE) AS is_autoship,
  CAST(oo.total AS DOUBLE) AS total, oo.order_date, oo.created_date, strftime(oo.ingested_at, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at, pr.n, pr.items_total, pr.codes
 FROM oo JOIN ids USING (client, id) JOIN clients c USING (client) LEFT JOIN pr ON pr.client = oo.client AND pr.order_id = oo.id
 LEFT JOIN tu ON tu.client = oo.client AND tu.id = oo.tree_user_id LEFT JOIN ty ON ty.client = tu.client AND ty.id = tu.user_type_id
 LEFT JOIN ot2 ON ot2.client = oo.client AND ot2.id = oo.order_type_id LEFT JOIN os ON os.client = oo.client AND os.id = oo.order_status_id)
SELECT client_partition_id, client, order_id, tree_user_id, client_type, client_status, is_autoship, total, ingested_at, coalesce(n, 0) AS products,
  CAST(items_total AS DOUBLE) AS items_total, codes,
  CASE WHEN client = 'america' THEN 'Customer' WHEN {TYPE} = 'Distributor' AND created_date <= order_date THEN 'Wholesale' ELSE 'Autoship' END AS type,
  CASE WHEN client = 'america' THEN 'Active' WHEN lower(client_status) IN ('ach declined', 'cancelled', 'cc declined') THEN 'Inactive' ELSE 'Active' END AS status,
  CASE WHEN client = 'america' THEN tree_user_id ELSE sponsor_id END AS commission_user_id
FROM r WHERE client = 'america' OR (client IN ('europe', 'africa') AND d IS NOT NULL)""")


def staging_contacts() -> str:
    return with_views(["lk_contacts", "lk_emails", "lk_phones", "lk_links", "lk_categories", "lk_tree_users", "lk_users", "clients"], f"""WITH
ids AS (SELECT client, id FROM lk_contacts WHERE {_between()} UNION SELECT client, contact_id FROM lk_emails WHERE {_between()}
  UNION SELECT client, contact_id FROM lk_phones WHERE {_between()} UNION SELECT client, contact_id FROM lk_links WHERE {_between()}),
pc AS {_latest('lk_contacts', 'client, id')}, tu AS {_latest('lk_tree_users', 'client, id')},
e AS (SELECT client, contact_id, count(*) AS emails, string_agg(email || ':' || preferred || ':' || undeliverable_count, ',' ORDER BY email) AS email_list
  FROM {_latest('lk_emails', 'client, contact_id, email')} GROUP BY 1, 2),
p AS (SELECT client, contact_id, count(*) AS phones, string_agg(phone_number, ',' ORDER BY phone_number) AS phone_list
  FROM {_latest('lk_phones', 'client, contact_id, unformatted_phone_number')} GROUP BY 1, 2),
n AS {_latest('lk_categories', 'client, id', 'event_id ASC, ingested_at DESC')},
k AS (SELECT l.client, contact_id, n.description AS category, strftime(created_at, '%Y-%m-%d') AS linked FROM {_latest('lk_links', 'client, contact_id')} l
  JOIN n ON n.client = l.client AND n.id = l.contact_category_id)
SELECT c.partition_id AS client_partition_id, pc.client, pc.id, pc.last_name, pc.event_id,
  CASE WHEN tu.id IS NOT NULL THEN tu.sponsor_id ELSE us.tree_user_id END AS owner_tree_user_id,
  CASE WHEN tu.id IS NOT NULL THEN us.id ELSE pc.user_id END AS owner_user_id, tu.id AS tree_user_id,
  CASE WHEN tu.id IS NOT NULL THEN pc.user_id END AS user_id, emails, email_list, phones, phone_list, category, linked
FROM pc JOIN ids USING (client, id) JOIN clients c USING (client) JOIN e ON e.client = pc.client AND e.contact_id = pc.id
JOIN p ON p.client = pc.client AND p.contact_id = pc.id JOIN k ON k.client = pc.client AND k.contact_id = pc.id
LEFT JOIN tu ON tu.client = pc.client AND tu.id = pc.tree_user_id LEFT JOIN lk_users us ON us.client = pc.client AND us.id = pc.user_id""")


def pii_users() -> str:
    where = f"ingested_at > TIMESTAMP '{FIRST}' AND ingested_at <= TIMESTAMP '{LAST}'"
    return with_views(["lk_tree_users", "clients"], f"""
SELECT c.partition_id AS client_partition_id, c.partner_id AS client_partner_id, t.client, event_id, id AS tree_user_id, first_name, last_name, company_name,
  address1 || CASE WHEN address2 <> '' THEN ' ' || address2 ELSE '' END AS street, city, state, country, email, phone, mobile_phone,
  CASE gender WHEN 'F' THEN 'female' WHEN 'male' THEN 'male' ELSE 'none' END AS gender, CAST(birth_date AS VARCHAR) AS birth_date,
  strftime(created_date, '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM {_latest('lk_tree_users', 'client, id', where=where)} t JOIN clients c USING (client)""")
