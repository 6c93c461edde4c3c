"""Oracle SQL of state between runs, repeated loads, trees and range joins: full histories, recursion, plain inequalities."""

from oracle.ingest import F, replay_upsert
from oracle.refine import LAST, _latest, staging_contacts, staging_users
from oracle.views import VIEWS, with_views

T = "'%Y-%m-%d %H:%M:%S.%f'"


def _until(sql: str, *names: str) -> str:
    """The same SQL over histories that end with the last window."""
    for name in names:
        text = VIEWS[name][1].strip()
        assert f"{name} AS ({text})" in sql, name
        sql = sql.replace(f"{name} AS ({text})", f"{name} AS (SELECT * FROM ({text}) WHERE ingested_at BETWEEN TIMESTAMP '1970-01-01' AND TIMESTAMP '{LAST}')")
    return sql


def bucket_upsert() -> str:
    return with_views(["lk_items"], f"""
SELECT client, id, event_id, strftime(ingested_at, {F}) AS ingested_at, product_id, quantity FROM {_latest('lk_items', 'client, id', where='ingested_at IS NOT NULL')}""")


def users_from_states() -> str:
    return _until(staging_users(), "lk_tree_users", "lk_users")


def contacts_from_states() -> str:
    return _until(staging_contacts(), "lk_contacts", "lk_emails", "lk_phones", "lk_links", "lk_tree_users", "lk_users")


def compacted_state() -> str:
    return replay_upsert()


def reload_after_crash() -> str:
    return """WITH r AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'no key opens it' WHEN doc_id % 13 = 0 THEN 'not of its type: doc_id' ELSE 'good' END AS reason FROM documents)
SELECT reason, count(*) AS n, count(DISTINCT CASE WHEN reason = 'good' THEN doc_id END) AS ids FROM r GROUP BY 1"""


UP = """up(tree_user_id, upline_id, distance) AS (
  SELECT c.tree_user_id, c.sponsor_id, 1 FROM u c JOIN u p ON p.tree_user_id = c.sponsor_id
  UNION ALL SELECT up.tree_user_id, c.sponsor_id, distance + 1 FROM up JOIN u c ON c.tree_user_id = up.upline_id JOIN u p ON p.tree_user_id = c.sponsor_id)"""


def upline_closure() -> str:
    return with_views(["u"], f"WITH {UP} SELECT * FROM up", recursive=True)


def nested_sets() -> str:
    return with_views(["u", "o"], f"""WITH {UP},
walk(id, depth, path) AS (SELECT tree_user_id, 0, [tree_user_id] FROM u WHERE sponsor_id IS NULL OR sponsor_id NOT IN (SELECT tree_user_id FROM u)
  UNION ALL SELECT u.tree_user_id, depth + 1, list_append(path, u.tree_user_id) FROM walk JOIN u ON u.sponsor_id = walk.id),
placed AS (SELECT id, depth, row_number() OVER (ORDER BY path) AS r FROM walk),
below AS (SELECT tree_user_id AS id, tree_user_id AS member FROM u UNION ALL SELECT upline_id, tree_user_id FROM up),
sizes AS (SELECT id, count(*) AS size FROM below GROUP BY 1),
bought AS (SELECT b.id, count(o.order_id) AS orders, coalesce(sum(o.total), 0) AS value FROM below b LEFT JOIN o ON o.commission_user_id = b.member GROUP BY 1)
SELECT p.id, CAST(p.depth AS BIGINT) AS depth, size, 2 * r - 1 - depth AS lft, 2 * r - 2 - depth + 2 * size AS rgt, orders, CAST(value AS DOUBLE) AS value
FROM placed p JOIN sizes s ON s.id = p.id JOIN bought b ON b.id = p.id""", recursive=True)


def elapsed_time_pairs() -> str:
    return with_views(["u", "upline"], f"""
SELECT h.client, h.tree_user_id AS upline_id, count(*) AS members, CAST(sum(date_diff('day', h.created, m.created)) AS BIGINT) AS days, strftime(max(m.created), {T}) AS last
FROM upline x JOIN u m ON m.tree_user_id = x.tree_user_id JOIN u h ON h.tree_user_id = x.upline_id AND h.client = m.client
WHERE m.created >= h.created AND m.created <= h.created + INTERVAL 30 DAY GROUP BY 1, 2""")


def logins_before_first_order() -> str:
    return with_views(["u", "o", "logins"], f"""WITH f AS (SELECT tree_user_id, min(order_date) AS first_order FROM o GROUP BY 1)
SELECT l.user_id, count(*) AS logins, strftime(min(l.created_at), {T}) AS first FROM logins l JOIN u ON u.tree_user_id = l.user_id JOIN f ON f.tree_user_id = l.user_id
WHERE l.created_at >= u.created AND l.created_at <= f.first_order GROUP BY 1""")
