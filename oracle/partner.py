"""Oracle SQL of the partner export: each table by its own SQL, filtered by creation time and counted."""

from oracle import assembly, refine
from oracle.views import BASE

CREATED_AFTER = "1995-05-01"


def export_nine_tables() -> str:
    day = f"'{CREATED_AFTER} 00:00:00.000000'"
    moment = f"TIMESTAMP '{CREATED_AFTER}'"
    kept = {
        "pii.users": (refine.pii_users(), "tree_user_id", "0", "birth_date IS NULL", f"created_at >= {day}"),
        "staging.emails": (assembly.staging_emails(), "message_id", "recipients", "sender_tree_user_id IS NULL", f"message_created_at >= {day}"),
        "staging.flat_site_visitors": (assembly.site_visitors(), "visitor_id", "0", "tracking_code IS NULL", f"created_at >= {day}"),
        "staging.orders": (refine.staging_orders(), "order_id", "products", "TRUE",
                           f"(SELECT o_orderdate - to_days(CAST(o_orderkey % 2 AS INTEGER)) FROM orders WHERE o_orderkey = order_id) >= {moment}"),
        "staging.product_reviews": (assembly.product_reviews(), "user_id", "0", "product_discontinue_on IS NULL", f"created_at >= {day}"),
        "staging.sites": (assembly.staging_sites(), "site_id", "visitors + CASE WHEN codes <> '' THEN 1 ELSE 0 END", "visits IS NULL", f"created_at >= {day}"),
        "staging.tasks": (assembly.tasks(), "id", "0", "completed_at IS NULL", f"created_at >= {day}"),
        "staging.users": (refine.staging_users(), "tree_user_id", "0", "user_id IS NULL", f"{BASE} + to_days(CAST(tree_user_id % 730 AS INTEGER)) >= {moment}"),
        "staging.contacts": (refine.staging_contacts(), "id", "emails + phones + 1", "tree_user_id IS NULL", f"{BASE} + to_days(CAST(id % 730 AS INTEGER)) >= {moment}"),
    }
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", count(*) AS n, CAST(sum({key}) AS BIGINT) AS keys, CAST(coalesce(sum({nested}), 0) AS BIGINT) AS nested,
  count(CASE WHEN {blank} THEN 1 END) AS blank FROM ({sql}) x WHERE {where}""" for table, (sql, key, nested, blank, where) in kept.items())
