"""Oracle SQL of the round trips: what went in must come out."""

from oracle.views import with_views

F = "'%Y-%m-%d %H:%M:%S.%f'"


def documents() -> str:
    return """SELECT 'europe' AS client, 'z/' || lpad(CAST(doc_id AS VARCHAR), 13, '0') AS event_id, doc_id, lang, md5(text) AS text_md5, length(text) AS chars,
  '2019-01-26 17:34:26.000000' AS read_at FROM documents"""


def compress_roundtrip() -> str:
    return "SELECT doc_id, md5(text) AS text_md5, length(text) > 1000 AS smaller FROM documents"


def csv_ingest() -> str:
    return """SELECT 'e' || c_custkey AS entity_id, CASE WHEN c_custkey % 13 > 0 THEN c_custkey END AS tree_user_id, lower(c_mktsegment) AS prediction, 'p-1' AS client_partner_id,
  'trial' AS expirement_name, '2020-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 10:00:00.000000' AS processing_datetime,
  CASE WHEN c_custkey % 13 = 0 THEN 'tree_user_id' ELSE '' END AS rejects FROM customer"""


def json_export() -> str:
    return with_views(["u"], """
SELECT '{"tree_user_id": ' || tree_user_id || ', "sponsor_id": ' || coalesce(CAST(sponsor_id AS VARCHAR), '""') || ', "client": "' || client || '", "signup": "' || CAST(CAST(created AS DATE) AS VARCHAR)
  || '", "created": "' || strftime(created, '%Y-%m-%d %H:%M:%S') || '", "in_credit": ' || CASE WHEN tree_user_id % 3 > 0 THEN CASE WHEN c_acctbal > 0 THEN '1' ELSE '0' END ELSE '""' END
  || ', "balance": ' || CASE WHEN tree_user_id % 4 > 0 THEN CAST(c_acctbal AS VARCHAR) ELSE '""' END || '}' AS value
FROM u JOIN customer ON c_custkey = tree_user_id""")


def export_files() -> str:
    return "SELECT o_orderkey, o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders"


def zero_date_scrub() -> str:
    day = "CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 7 > 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END"
    moment = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"
    return f"SELECT o_orderkey, {day} AS at_top, {moment} AS moment, strftime(o_orderdate, '%Y-%m-%d') AS day, {day} AS at_1, {moment} AS moment_1, {day} AS at_2, o_custkey AS n FROM orders"


def temporal_coercion() -> str:
    ok = "o_orderkey % 10 > 0"
    wall = "date_trunc('day', o_orderdate) + INTERVAL 14 HOURS"
    return f"""SELECT o_orderkey, CASE WHEN {ok} THEN strftime({wall}, {F}) END AS wall, CASE WHEN {ok} THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
  CASE WHEN {ok} THEN strftime({wall} - INTERVAL 330 MINUTES, {F}) END AS instant, CASE WHEN {ok} THEN strftime({wall}, {F}) END AS list, NULL AS added,
  CASE WHEN {ok} THEN '' ELSE 'wall,day,instant' END AS rejects FROM orders"""


def replay_upsert() -> str:
    return with_views(["lk_emails"], f"""SELECT client, contact_id, email, event_id, strftime(ingested_at, {F}) AS ingested_at, undeliverable_count
FROM (SELECT *, row_number() OVER (PARTITION BY client, contact_id, email ORDER BY event_id DESC, ingested_at DESC) AS rn FROM lk_emails) WHERE rn = 1""")


def bounded_batches() -> str:
    return "SELECT count(*) AS rows_kept, CAST(sum(length(text)) AS BIGINT) AS chars_kept, 0 AS over_bound, 0 AS mergeable FROM documents"


def ingest_rejects() -> str:
    return """WITH r AS (SELECT CASE WHEN doc_id % 11 = 0 THEN 'not a record'
    WHEN doc_id % 13 = 0 AND doc_id % 17 = 0 THEN 'not of its type: doc_id; without client'
    WHEN doc_id % 13 = 0 THEN 'not of its type: doc_id' WHEN doc_id % 17 = 0 THEN 'without client' ELSE 'good' END AS reason FROM documents)
SELECT reason, count(*) AS n, count(CASE WHEN reason = 'good' THEN 1 END) AS with_id FROM r GROUP BY 1"""


def append_and_reload() -> str:
    return """WITH o AS (SELECT o_orderkey, o_custkey % 4 AS client_partition_id FROM orders)
SELECT client_partition_id, count(*) AS n, 0 AS notes, CAST(sum(o_orderkey) AS BIGINT) AS keys, 'append' AS step FROM o GROUP BY 1
UNION ALL SELECT client_partition_id, count(*), 0, CAST(sum(o_orderkey) AS BIGINT), 'reload' FROM o WHERE client_partition_id = 3 GROUP BY 1"""


def window_retry() -> str:
    return with_views(["lk_orders"], f"""WITH b AS (SELECT max(ingested_at) AS m FROM lk_orders WHERE ingested_at < TIMESTAMP '1996-01-01'),
w AS (SELECT 1 AS w, client, event_id, ingested_at FROM lk_orders, b WHERE ingested_at <= m UNION ALL SELECT 2, client, event_id, ingested_at FROM lk_orders, b WHERE ingested_at >= m)
SELECT client, count(*) AS n, min(event_id) AS first_event, strftime(max(ingested_at), {F}) AS last FROM w GROUP BY client, w""")


def tapped_rows() -> str:
    return 'SELECT count(*) AS "rows", CAST(sum(o_orderkey) AS BIGINT) AS keys, min(o_custkey) AS least, count(*) AS written FROM orders'


def archived_files() -> str:
    return "SELECT count(*) AS rows_read, CAST(sum(n_chars) AS BIGINT) AS chars, true AS archived FROM documents"
