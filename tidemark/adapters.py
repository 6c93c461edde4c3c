"""The engine's tables derived from the given star-schema tables.

Staging views (users, orders, items, logins, messages) feed the reports; the
lake views are versioned change records that feed the refine jobs. Everything
is a projection or join of whole tables, so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.nesting import nest_children
from tidemark.plans import lineage
from tidemark.session import cut, spread


class Star:
    """The given parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._customers: int | None = None
        self._upline: DataFrame | None = None
        self._placed: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is read from the files once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def documents(self) -> DataFrame:
        """Texts, spread over the cores before they are parsed or compressed."""
        return spread(self.table("documents"), "doc_id")

    # ---- staging views -------------------------------------------------

    def customers_with_tenant(self) -> DataFrame:
        """Customers with nation name and tenant (= region, lower-cased)."""
        nation, region = self.table("nation"), self.table("region")
        place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
            "n_nationkey", "n_name", "r_name", "lower(r_name) AS client"
        )
        return self.table("customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))

    def users(self) -> DataFrame:
        return self.customers_with_tenant().selectExpr(
            "c_custkey AS tree_user_id",
            "c_custkey AS user_id",
            "CASE WHEN c_custkey > 0 THEN c_custkey div 10 END AS sponsor_id",
            "timestampadd(DAY, c_custkey % 730, timestamp_ntz'1995-01-01 00:00:00') AS created",
            "timestampadd(DAY, c_custkey % 730, timestamp_ntz'1995-01-01 00:00:00') AS coded",
            "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'Distributor' ELSE 'Customer' END AS type",
            "c_mktsegment AS client_type",
            "client",
            "n_name AS country",
        )

    @staticmethod
    def _large(df: DataFrame) -> DataFrame:
        """Side of a join of two tables that both grow.

        Estimates multiply along joins, so on small data Spark would broadcast the
        larger table and stream the smaller through one task.
        """
        return df.hint("merge")

    def customer_count(self) -> int:
        """Answered from parquet metadata, once."""
        if self._customers is None:
            self._customers = self.table("customer").count()
        return self._customers

    def orders(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS commission_user_id",
            f"CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE (o_custkey + 1) % {self.customer_count()} END AS tree_user_id",
            "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Retail'"
            " WHEN o_orderpriority = '3-MEDIUM' THEN 'Wholesale' ELSE 'Autoship' END AS type",
            "o_orderpriority = '5-LOW' AS is_autoship",
            "CASE WHEN o_orderstatus = 'P' THEN 'Cancelled' ELSE 'Active' END AS status",
            "CAST(o_totalprice AS DECIMAL(19,4)) AS total",
            "CAST(o_orderkey % 100 AS DECIMAL(19,4)) AS bv_total",
            "CAST(o_custkey % 50 AS DECIMAL(19,4)) AS cv_total",
            "o_orderdate AS order_date",
        )

    def order_items(self) -> DataFrame:
        """Latest-version-ready order items: key (order_id, line), version columns last."""
        return self.table("lineitem").selectExpr(
            "l_orderkey AS order_id", "l_linenumber AS line", "l_partkey AS product_id", "l_suppkey AS supplier_id",
            "CAST(l_quantity AS BIGINT) AS quantity", "CAST(l_extendedprice AS DECIMAL(19,4)) AS price_total",
            "l_shipdate AS shipped",
        )

    def order_products(self) -> DataFrame:
        """(order_id, tree_user_id, status, product_description, price_total) per item."""
        part = self.table("part").selectExpr(
            "p_partkey AS product_id",
            "concat(p_name, ' ', CASE p_type WHEN 'ECONOMY' THEN 'Monthly RBS' WHEN 'PROMO' THEN 'Get4Discount DTP'"
            " WHEN 'STANDARD' THEN 'Reactivation DT Gold' WHEN 'MEDIUM' THEN 'Preview Event' WHEN 'SMALL' THEN 'Pick Your Product'"
            " ELSE 'College month WVA' END) AS product_description",
        )
        return (
            self.order_items()
            .join(self._large(self.orders().select("order_id", "tree_user_id", "status", "order_date")), "order_id")
            .join(self._large(part), "product_id")
        )

    def logins(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS id",
            "user_id",
            "CASE WHEN event_type = 'error' THEN NULL"
            " WHEN event_id % 10 = 0 THEN 'Linux x86' WHEN event_id % 10 = 1 THEN 'ChromeOS'"
            " WHEN event_id % 10 = 2 THEN 'Fedora' WHEN event_id % 10 = 3 THEN 'Windows Phone'"
            " WHEN event_type = 'click' THEN 'Android 9' WHEN event_type = 'view' THEN 'Windows'"
            " WHEN event_type = 'purchase' THEN 'iPhone' ELSE 'Intel Mac OS X 10' END AS platform",
            "ts - INTERVAL 29 YEARS AS created_at",
            "CASE WHEN event_id % 7 = 0 THEN user_id END AS proxied_by_id",
        )

    def messages(self) -> DataFrame:
        """Sent messages with nested recipients; one recipient per conversation turn."""
        turns = self.table("conversations").selectExpr(
            f"conv_id % {self.customer_count()} AS sender_tree_user_id",
            "conv_id AS message_id",
            "timestampadd(DAY, (conv_id * 3) % 400, timestamp_ntz'1995-01-01 00:00:00') AS created",
            "timestampadd(HOUR, ((conv_id * 3) % 400) * 24 + conv_id % 48, timestamp_ntz'1995-01-01 00:00:00') AS sent",
            "turn AS recipient_tree_user_id",
            "turn AS day",
        ).withColumns({
            "seen": F.expr("CASE WHEN day > 1 THEN timestampadd(DAY, day, created) END"),
            "read": F.expr("CASE WHEN day > 2 THEN timestampadd(DAY, day * 2, created) END"),
            "undeliverable": F.expr("CASE WHEN day % 4 = 3 THEN created END"),
        })
        return nest_children(
            turns,
            ["sender_tree_user_id", "message_id", "created", "sent"],
            ["recipient_tree_user_id", "seen", "read", "undeliverable"],
            "recipients",
        )

    def upline(self) -> DataFrame:
        """Closure of the sponsor tree, from its edges: every member with each of its uplines."""
        if self._upline is None:
            edges = self.table("customer").selectExpr("c_custkey AS tree_user_id", "CASE WHEN c_custkey > 0 THEN c_custkey div 10 END AS sponsor_id")
            self._upline = lineage.upline(edges)
        return self._upline

    def documents_by_quality(self) -> DataFrame:
        """Texts in the two groups (quality 1 / 0) of the topic models."""
        return self.documents().select("doc_id", "text").join(
            self._large(self.table("labels").select("doc_id", "quality")), "doc_id"
        )

    def ratings(self) -> DataFrame:
        """Latest rating 1..5 per (user, product)."""
        return self.table("lineitem").join(
            self._large(self.table("orders").select("o_orderkey", "o_custkey")), F.col("l_orderkey") == F.col("o_orderkey")
        ).groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("product_id")).agg(
            F.max_by(
                F.expr("CAST(1 + CAST(l_quantity AS BIGINT) % 5 AS INT)"),
                F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"),
            ).alias("rating")
        )

    # ---- lake views (versioned) ----------------------------------------

    def _places(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).selectExpr("n_nationkey", "n_name", "lower(r_name) AS client")

    def _described(self, words: list[str], stale: str = "stale") -> DataFrame:
        """(client, id, description): five versions per id, the last one valid."""
        listed = ", ".join(f"'{w}'" for w in words)
        return self._places().selectExpr(
            "client", "n_nationkey", f"posexplode(array({listed})) AS (pos, word)"
        ).selectExpr(
            "client",
            "concat('z/', lpad(CAST(n_nationkey AS STRING), 4, '0')) AS event_id",
            "timestampadd(HOUR, n_nationkey, timestamp_ntz'1995-01-01 00:00:00') AS ingested_at",
            "CAST(pos + 1 AS BIGINT) AS id",
            f"CASE WHEN n_nationkey >= 20 THEN word ELSE '{stale}' END AS description",
        )

    def lake_user_types(self) -> DataFrame:
        return self._described(["Distributor", "Pending Transfer", "MarketPlace Customer", "Employee", "B2B"])

    def lake_user_statuses(self) -> DataFrame:
        return self._described(["Active", "Hold", "Terminated"])

    def lake_order_types(self) -> DataFrame:
        return self._described(["Shopping Cart", "Web Wizard", "Import", "API Order", "Recurring Order"])

    def lake_order_statuses(self) -> DataFrame:
        return self._described(["Cancelled", "Shipped", "CC Declined"])

    def lake_ranks(self) -> DataFrame:
        return self._places().selectExpr(
            "client", "'z/0' AS event_id", "timestamp_ntz'1995-01-01 00:00:00' AS ingested_at",
            "CAST(n_nationkey AS BIGINT) AS id", "n_name AS name", "CAST((n_nationkey div 5) * 10 AS BIGINT) AS level",
        )

    def lake_tree_users(self) -> DataFrame:
        """A user change per order of the customer."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        return self.customers_with_tenant().join(self._large(orders), F.col("c_custkey") == F.col("o_custkey")).selectExpr(
            "client",
            "concat('z/', date_format(o_orderdate, 'yyyy/MM/dd/HH/mm'), '/', lpad(CAST(o_orderkey AS STRING), 13, '0'), '-0000000') AS event_id",
            "timestampadd(DAY, o_orderkey % 3, o_orderdate) AS ingested_at",
            "c_custkey AS id",
            "CASE WHEN c_custkey > 0 THEN c_custkey div 10 END AS sponsor_id",
            "CASE WHEN c_custkey > 0 THEN c_custkey div 10 END AS parent_id",
            "CASE WHEN o_orderkey % 97 > 0 THEN CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2"
            " WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END END AS user_type_id",
            "CASE o_orderstatus WHEN 'P' THEN 3 WHEN 'O' THEN 1 ELSE 2 END AS user_status_id",
            "CASE WHEN o_orderkey % 89 > 0 THEN CAST((c_custkey % 5) * 10 AS BIGINT) END AS rank_id",
            "CAST((c_nationkey div 5) * 10 AS BIGINT) AS paid_rank_id",
            "lpad(CAST(o_orderkey % 100000 AS STRING), 5, '0') AS zip",
            "timestampadd(DAY, c_custkey % 730, timestamp_ntz'1995-01-01 00:00:00') AS created_date",
            "o_orderdate AS updated_date",
            "timestampadd(DAY, c_custkey % 730, timestamp_ntz'1995-01-01 00:00:00') AS coded_date",
            "split(c_name, '#')[0] AS first_name", "split(c_name, '#')[1] AS last_name", "c_mktsegment AS company_name",
            "n_name AS address1",
            "CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('Suite ', o_orderkey) END AS address2",
            "r_name AS city", "o_orderstatus AS state", "n_name AS country",
            "concat(c_custkey, '@example.com') AS email", "concat('555-', o_orderkey) AS phone", "'' AS mobile_phone",
            "CASE o_orderkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'male' WHEN 2 THEN 'x' END AS gender",
            "date_add(date'1950-01-01', CAST(c_custkey % 20000 AS INT)) AS birth_date",
        )

    def lake_users(self) -> DataFrame:
        return self.customers_with_tenant().selectExpr(
            "client", "'z/0' AS event_id",
            "timestampadd(DAY, c_custkey % 730, timestamp_ntz'1995-01-01 00:00:00') AS ingested_at",
            "c_custkey + 1000000 AS id", "c_custkey AS tree_user_id",
        )

    def _order_tenants(self) -> DataFrame:
        """Orders with their customer's tenant."""
        if self._placed is not None:
            return self._placed
        return self.table("orders").join(
            self._large(self.customers_with_tenant().select("c_custkey", "client")), F.col("o_custkey") == F.col("c_custkey")
        )

    def place_orders(self) -> None:
        """Write the orders with their tenant once, for the lake tables that are projections of them."""
        if self._placed is None:
            self._placed = cut(self._order_tenants().drop("c_custkey"), "placed-orders")

    def lake_orders(self) -> DataFrame:
        """Orders; those of status F are replayed a day later with another total."""
        return self._order_tenants().withColumn(
            "v", F.explode(F.expr("CASE WHEN o_orderstatus = 'F' THEN array(0, 1) ELSE array(0) END"))
        ).selectExpr(
            "client",
            "concat('z/', date_format(o_orderdate, 'yyyy/MM/dd/HH/mm'), '/', lpad(CAST(o_orderkey AS STRING), 13, '0'), '-0000000') AS event_id",
            "timestampadd(DAY, v, o_orderdate) AS ingested_at",
            "o_orderkey AS id",
            f"CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE (o_custkey + 1) % {self.customer_count()} END AS tree_user_id",
            "CASE WHEN o_orderpriority = '5-LOW' THEN o_orderkey WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 0 END AS autoship_template_id",
            "CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS order_status_id",
            "CAST(substring(o_orderpriority, 1, 1) AS INT) AS order_type_id",
            "o_orderkey + 7 AS client_order_id",
            "CAST(o_custkey AS STRING) AS client_user_id",
            "'USD' AS currency_code", "CAST(NULL AS STRING) AS discount_code", "'UTC' AS timezone",
            "CAST(NULL AS STRING) AS tracking_number",
            "CAST(NULL AS STRING) AS shipping_city", "CAST(NULL AS STRING) AS shipping_state",
            "CAST(NULL AS STRING) AS shipping_zip", "CAST(NULL AS STRING) AS shipping_country",
            "CAST(NULL AS STRING) AS shipping_county",
            "o_orderdate AS order_date", "timestampadd(DAY, 3, o_orderdate) AS shipped_date",
            "timestampadd(DAY, -(o_orderkey % 2), o_orderdate) AS created_date", "o_orderdate AS modified_date",
            "CAST(o_totalprice + v AS DECIMAL(19,4)) AS total", "CAST(o_totalprice AS DECIMAL(19,4)) AS sub_total",
            "CAST(0 AS DECIMAL(19,4)) AS tax_total", "CAST(0 AS DECIMAL(19,4)) AS shipping_total",
            "CAST(o_orderkey % 100 AS DECIMAL(19,4)) AS bv_total", "CAST(o_custkey % 50 AS DECIMAL(19,4)) AS cv_total",
            "CAST(0 AS DECIMAL(19,4)) AS discount_total",
        )

    def lake_order_items(self, orders: DataFrame | None = None) -> DataFrame:
        """Item versions, all or those of the given ``(client, order_id)`` alone.

        Those of given orders are dealt out by item as they are read, before they are widened: what ranks an item's
        versions then need not move them.
        """
        tenants = self._order_tenants().select("o_orderkey", "client")
        if orders is not None:
            tenants = tenants.join(orders.select("client", F.col("order_id").alias("o_orderkey")), ["client", "o_orderkey"], "left_semi")
        part = self.table("part").selectExpr("p_partkey", "p_brand", "concat(p_name, ' ', p_type) AS product_description")
        zero = "CAST(0 AS DECIMAL(19,4))"
        rows = self.table("lineitem").join(self._large(tenants), F.col("l_orderkey") == F.col("o_orderkey")).join(
            self._large(part), F.col("l_partkey") == F.col("p_partkey")
        ).withColumn("id", F.expr("l_orderkey * 10 + l_linenumber"))
        if orders is not None:
            rows = rows.repartition("client", "id")
        return rows.selectExpr(
            "client",
            "concat('z/', date_format(l_shipdate, 'yyyy/MM/dd/HH/mm'), '/', lpad(CAST(l_partkey AS STRING), 12, '0'), '-',"
            " lpad(CAST(l_suppkey AS STRING), 12, '0'), '-', lpad(CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS STRING), 20, '0')) AS event_id",
            "l_shipdate AS ingested_at",
            "id", "l_orderkey AS order_id", "l_partkey AS product_id",
            "p_brand AS product_code", "product_description", "CAST(l_quantity AS BIGINT) AS quantity",
            "CAST(l_extendedprice AS DECIMAL(19,4)) AS price_each", "CAST(l_extendedprice AS DECIMAL(19,4)) AS price_total",
            f"{zero} AS weight_each", f"{zero} AS weight_total", f"{zero} AS tax", f"{zero} AS bv", f"{zero} AS bv_each",
            f"{zero} AS cv_each", f"{zero} AS cv", "l_suppkey AS parent_product_id", "l_returnflag AS tracking_number",
            "CAST(NULL AS STRING) AS shipping_city", "CAST(NULL AS STRING) AS shipping_state",
            "CAST(NULL AS STRING) AS shipping_zip", "CAST(NULL AS STRING) AS shipping_county",
            "CAST(NULL AS STRING) AS shipping_country",
        )

    def lake_contacts(self) -> DataFrame:
        """Two versions per customer; those of odd key are no tree users themselves."""
        nothing = ["info", "avatar_file_name", "avatar_content_type", "avatar_file_size"]
        return self.customers_with_tenant().withColumn("v", F.explode(F.expr("array(0, 1)"))).selectExpr(
            "client",
            "concat('z/1995/', lpad(CAST(c_custkey % 730 + v AS STRING), 4, '0')) AS event_id",
            "timestampadd(DAY, c_custkey % 730 + v * 30, timestamp_ntz'1995-01-01 00:00:00') AS ingested_at",
            "c_custkey AS id", "c_custkey div 7 + 1000000 AS user_id",
            "CASE WHEN c_custkey % 2 = 0 THEN c_custkey END AS tree_user_id",
            "CAST(c_custkey % 3 AS BIGINT) AS contact_type", "CAST(c_custkey % 5 AS BIGINT) AS level_of_interest",
            "split(c_name, '#')[0] AS first_name", "concat(split(c_name, '#')[1], '-', v) AS last_name",
            "date_add(date'1950-01-01', CAST(c_custkey % 20000 AS INT)) AS birthday",
            "timestampadd(DAY, c_custkey % 730, timestamp_ntz'1995-01-01 00:00:00') AS created_at",
            "timestampadd(DAY, c_custkey % 730 + v, timestamp_ntz'1995-01-01 00:00:00') AS updated_at",
            "c_custkey % 2 = 1 AS is_downline_contact", "c_acctbal > 0 AS opt_in",
            *(f"CAST(NULL AS STRING) AS {c}" for c in nothing),
            "CAST(NULL AS TIMESTAMP_NTZ) AS avatar_updated_at",
            "n_name AS address1", "CAST(NULL AS STRING) AS address2", "r_name AS city", "CAST(NULL AS STRING) AS postal_code",
            "CAST(NULL AS STRING) AS state", "n_name AS country",
        )

    def lake_contact_emails(self) -> DataFrame:
        """Change records of contact e-mails: one per event of the contact."""
        tenants = self.customers_with_tenant().select("c_custkey", "client")
        return self.table("events").join(self._large(tenants), F.col("user_id") == F.col("c_custkey")).selectExpr(
            "client",
            "concat('z/', lpad(CAST(event_id AS STRING), 13, '0')) AS event_id",
            "ts - INTERVAL 29 YEARS AS ingested_at",
            "event_id AS id",
            "user_id AS contact_id", "concat(event_type, user_id, '@example.com') AS email", "event_type AS source",
            "value > 5 AS preferred", "event_id % 3 AS undeliverable_count", "event_id % 2 AS spam_reported_count",
        )

    def lake_contact_phones(self) -> DataFrame:
        return self._order_tenants().selectExpr(
            "client",
            "concat('z/', lpad(CAST(o_orderkey AS STRING), 13, '0')) AS event_id",
            "o_orderdate AS ingested_at", "o_orderkey AS id", "o_custkey AS contact_id",
            "concat('555-', o_orderkey) AS phone_number", "o_orderpriority AS label",
            "concat('555', substring(o_orderpriority, 1, 1)) AS unformatted_phone_number",
            "o_orderstatus AS source", "'1' AS dialing_code",
        )

    def lake_contact_category_links(self) -> DataFrame:
        return self._order_tenants().selectExpr(
            "client",
            "concat('z/', lpad(CAST(o_orderkey AS STRING), 13, '0')) AS event_id",
            "o_orderdate AS ingested_at", "o_orderkey AS id", "o_custkey AS contact_id",
            "CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS contact_category_id",
            "o_orderdate AS created_at", "timestampadd(DAY, 1, o_orderdate) AS updated_at",
        )

    def lake_contact_categories(self) -> DataFrame:
        """Three categories per tenant, five versions each; the earliest event names them."""
        return self._described(["Friend", "Family", "Work"], stale="first name").withColumnRenamed(
            "description", "category_name"
        )


class Lake(Mapping[str, DataFrame]):
    """Lake tables by name, each derived and written once, when a job first asks for it.

    Those that are projections of the orders with their tenant are not written, but these orders are. The widest and
    longest, the items, is not written either: jobs read a few columns of it to find what has changed, and then whole rows
    of those orders alone, which are picked before the items are joined to them.
    """

    PLACED = ("tree_orders", "tree_order_items", "pyr_contact_phone_numbers", "pyr_contacts_contact_categories")

    def __init__(self, star: Star):
        self._star = star
        self._written: dict[str, DataFrame] = {}
        self._makers = {
            "tree_users": star.lake_tree_users,
            "users": star.lake_users,
            "tree_user_types": star.lake_user_types,
            "tree_user_statuses": star.lake_user_statuses,
            "pyr_rank_definitions": star.lake_ranks,
            "tree_orders": star.lake_orders,
            "tree_order_items": star.lake_order_items,
            "tree_order_types": star.lake_order_types,
            "tree_order_statuses": star.lake_order_statuses,
            "pyr_contacts": star.lake_contacts,
            "pyr_contact_emails": star.lake_contact_emails,
            "pyr_contact_phone_numbers": star.lake_contact_phones,
            "pyr_contacts_contact_categories": star.lake_contact_category_links,
            "pyr_contact_categories": star.lake_contact_categories,
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._written:
            if name in self.PLACED:
                self._star.place_orders()
            rows = self._makers[name]()
            self._written[name] = rows if name in self.PLACED else cut(rows, f"lake-{name}")
        return self._written[name]

    def known(self, table: str, own: str, ids: DataFrame, key: str) -> DataFrame | None:
        """Full history of the entities in ``ids`` where that need not be picked from the whole table, else nothing."""
        if (table, own) != ("tree_order_items", "order_id"):
            return None
        self._star.place_orders()
        return self._star.lake_order_items(ids.select("client", F.col(key).alias("order_id")))

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
