"""Oracle SQL of the engagement, login and feature-table queries."""

from oracle.cohort import ROWS, ao_cte, ao_days, metrics_cte
from oracle.views import with_views

KINDS = ("retail", "wholesale", "autoship")


def _sent() -> str:
    """``sea``: engagement per sender, from distinct counts over exploded recipients."""
    cols = [f"date_diff('day', signup, min(CAST({m} AS DATE))) AS days_to_first_{n}"
            for n, m in (("created", "created"), ("sent", "sent"), ("seen", "min_seen"), ("read", "min_read"))]
    early = "date_diff('day', signup, CAST(created AS DATE)) BETWEEN 0 AND 30"
    for n in ("created", "sent"):
        cols.append(f"count(CASE WHEN {early} THEN message_id END) AS cnt_{n}_first30")
        cols += [f"count(CASE WHEN CAST({n} AS DATE) >= signup AND {n} <= first_{k}_order_date THEN message_id END) AS cnt_{n}_before_first_{k}" for k in KINDS]
    for n, m in (("seen", "min_seen"), ("read", "min_read"), ("undeliverable", "sent")):
        cols.append(f"CAST(sum(CASE WHEN {early} THEN {n}_cnt ELSE 0 END) AS BIGINT) AS cnt_{n}_first30")
        cols += [f"CAST(sum(CASE WHEN CAST({m} AS DATE) >= signup AND {m} <= first_{k}_order_date THEN {n}_cnt ELSE 0 END) AS BIGINT) AS cnt_{n}_before_first_{k}" for k in KINDS]
    return f"""
se AS (SELECT sender_tree_user_id, message_id, created, sent, count(DISTINCT turn) AS recipients_cnt, min(seen) AS min_seen,
    count(DISTINCT CASE WHEN seen IS NOT NULL THEN turn END) AS seen_cnt, min(read) AS min_read,
    count(DISTINCT CASE WHEN read IS NOT NULL THEN turn END) AS read_cnt,
    count(DISTINCT CASE WHEN undeliverable IS NOT NULL THEN turn END) AS undeliverable_cnt FROM turns GROUP BY 1, 2, 3, 4),
sea AS (SELECT sender_tree_user_id, {", ".join(cols)}
  FROM (SELECT se.*, CAST(u.created AS DATE) AS signup, {", ".join(f"ao.first_{k}_order_date" for k in KINDS)}
    FROM u JOIN se ON u.tree_user_id = se.sender_tree_user_id AND u.type = 'Distributor' LEFT JOIN ao ON ao.commission_user_id = u.tree_user_id)
  WHERE CAST(created AS DATE) >= signup GROUP BY sender_tree_user_id, signup)"""


PLATFORM = {
    "unknown": "platform IS NULL", "android": "platform LIKE 'Android%'", "iphone": "platform LIKE 'iPhone%'", "ipad": "platform LIKE 'iPad%'",
    "windows": "platform = 'Windows'", "macos": "(platform = 'Macintosh' OR platform LIKE '%OS X%')",
    "linux": "(platform LIKE 'Linux%' OR platform LIKE 'linux%' OR platform = 'Fedora')", "chromeos": "platform = 'ChromeOS'",
}
PLATFORM["other"] = " AND ".join(f"NOT ({t})" for n, t in PLATFORM.items() if n != "unknown")


def _logins() -> str:
    when = {"first30": "date_diff('day', signup, CAST(created_at AS DATE)) BETWEEN 0 AND 30"}
    when |= {f"before_first_{k}": f"created_at BETWEEN CAST(signup AS TIMESTAMP) AND first_{k}_order_date" for k in KINDS}
    cols = ", ".join(f"count(CASE WHEN {t} AND {w} THEN id END) AS logins_{n}_{p}" for n, w in when.items() for p, t in PLATFORM.items())
    return f"lo AS (SELECT u.tree_user_id, {cols} FROM logins JOIN u ON logins.user_id = u.user_id AND u.type = 'Distributor' JOIN ao ON ao.commission_user_id = u.tree_user_id GROUP BY 1)"


def engagement_features() -> str:
    return with_views(["u", "o", "turns"], f"WITH {ROWS},\n{ao_cte()},{_sent()}\nSELECT * FROM sea")


def login_platform_counts() -> str:
    return with_views(["u", "o", "logins"], f"WITH {ROWS},\n{ao_cte()},\n{_logins()}\nSELECT * FROM lo")


def usage_features() -> str:
    return with_views(["u", "o", "turns", "logins"], f"""WITH {ROWS},
{ao_cte()},
{metrics_cte()},{_sent()},
{_logins()},
ad AS (SELECT commission_user_id, CAST(signup AS VARCHAR) AS signup, {ao_days()} FROM ao)
SELECT om.*, ad.* EXCLUDE (commission_user_id), sea.* EXCLUDE (sender_tree_user_id), lo.* EXCLUDE (tree_user_id)
FROM om LEFT JOIN ad ON om.commission_user_id = ad.commission_user_id LEFT JOIN sea ON om.commission_user_id = sea.sender_tree_user_id
LEFT JOIN lo ON om.commission_user_id = lo.tree_user_id""")


def own_logins() -> str:
    return with_views(["u", "logins"], """
SELECT logins.user_id, id, platform, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, tree_user_id
FROM logins JOIN u ON logins.user_id = u.user_id WHERE proxied_by_id IS NULL""")
