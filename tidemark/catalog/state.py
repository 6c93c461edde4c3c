"""State between runs: keyed tables, refine jobs on kept versions, streams folded into a table, repeated loads, trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.adapters import Star
from tidemark.catalog.base import FIRST, LAST, query
from tidemark.catalog.ingest import DOCUMENT_LAKE, DOCUMENT_TEXTS, NEW_KEY, OLD_KEY
from tidemark.catalog.refine import RULES, contact_rows, lake_tables, tenant_table, user_rows
from tidemark.functions import codec
from tidemark.operators import ranges
from tidemark.operators.versions import in_window
from tidemark.plans import lineage, load, refine, states
from tidemark.session import cut, work_dir
from tidemark.sinks.keyed import KeyedTable
from tidemark.sources.ledger import FileLedger
from tidemark.streaming import ingest

MIDDLE = "1996-07-01"
DIMENSIONS = ("tree_user_types", "tree_user_statuses", "pyr_rank_definitions", "pyr_contact_categories")


class Lost(RuntimeError):
    """A run that ends before its commit, on purpose."""


class DyingTable(KeyedTable):
    def _commit(self, version) -> None:
        raise Lost("the run is lost before its manifest")


class DyingLedger(FileLedger):
    def commit(self, load) -> None:
        raise Lost("the load is lost before its commit")


# ---- keyed tables ------------------------------------------------------------


@query("bucket_upsert")
def _(s: Star) -> DataFrame:
    """Item versions merged into a keyed table year by year; one merge dies before its manifest and is repeated."""
    rows = s.lake_order_items().select("client", "id", "event_id", "ingested_at", "product_id", "quantity")
    rows = cut(rows.filter(F.col("ingested_at").isNotNull()), "versions")
    path = f"{work_dir(s.spark, 'items')}/table"
    table = KeyedTable(s.spark, path, rows.schema, ["client", "id"], buckets=16)
    year = F.year("ingested_at")
    table.merge(rows.filter(year < 1996))
    dying = DyingTable(s.spark, path, rows.schema, ["client", "id"], buckets=16)
    try:
        dying.merge(rows.filter(year == 1996))
    except Lost:
        pass
    for part in (rows.filter(year == 1996), rows.filter(year == 1996), rows.filter(year > 1996)):
        table.merge(part)
    table.vacuum()
    return table.read()


def _states(s: Star, wanted: set[tuple[str, str]]) -> states.StatefulLake:
    """The wanted states after three windows, the last one up to ``LAST``; the lake ends there too."""
    lake = lake_tables(s)
    ended = {name for name, _ in wanted}
    known = {name: in_window(lake[name], "1970-01-01", LAST) if name in ended else lake[name] for name in {*DIMENSIONS, *ended}}
    kept = states.StatefulLake(s.spark, known, work_dir(s.spark, "states"), buckets=8, names={k: v for k, v in states.STATES.items() if k in wanted})
    for first, last in ((None, FIRST), (FIRST, MIDDLE), (MIDDLE, LAST)):
        kept.advance(first, last)
    return kept


@query("users_from_states")
def _(s: Star) -> DataFrame:
    kept = _states(s, {("tree_users", "id"), ("users", "tree_user_id")})
    return user_rows(refine.staging_users(kept, tenant_table(s), RULES, FIRST, LAST))


@query("contacts_from_states")
def _(s: Star) -> DataFrame:
    kept = _states(s, {k for k in states.STATES if k[0].startswith("pyr_")} | {("tree_users", "id"), ("users", "id")})
    return contact_rows(refine.staging_contacts(kept, tenant_table(s), FIRST, LAST))


@query("compacted_state")
def _(s: Star) -> DataFrame:
    """E-mail changes arriving in files, a batch each; open batches are folded into the table three by three."""
    base = work_dir(s.spark, "folded")
    rows = s.lake_contact_emails().select("client", "contact_id", "email", "event_id", "ingested_at", "undeliverable_count")
    rows.repartition(8).write.parquet(f"{base}/in")
    stream = s.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    table = KeyedTable(s.spark, f"{base}/table", rows.schema, ["client", "contact_id", "email"], ["client", "contact_id"], buckets=8)
    ingest.run_keyed(stream, table, f"{base}/checkpoint", fold_after=3)
    return table.read()


# ---- loads -------------------------------------------------------------------


@query("reload_after_crash")
def _(s: Star) -> DataFrame:
    """Change files loaded by ledger: the first load dies after its output, another file arrives, two runs follow."""
    base = work_dir(s.spark, "loads")
    record = F.to_json(F.struct(
        F.lit("europe").alias("client"), F.concat(F.lit("z/"), F.col("doc_id").cast("string")).alias("event_id"),
        F.expr("concat(CASE WHEN doc_id % 13 = 0 THEN 'x' ELSE '' END, doc_id)").alias("doc_id"), "lang", F.lit("2019-01-26T17:34:26.000Z").alias("read_at"),
    ))
    sealed = F.when(F.col("doc_id") % 11 == 0, F.lit("00:00")).otherwise(codec.encrypt_line(record, NEW_KEY))
    lines = s.documents().select("doc_id", sealed.alias("value"))
    target = T.StructType([f for f in DOCUMENT_LAKE.fields if f.name != "text"])
    texts = T.StructType([f for f in DOCUMENT_TEXTS.fields if f.name != "text"])

    def run(ledger: FileLedger) -> bool:
        return load.load_changes(s.spark, f"{base}/in", "part-", [OLD_KEY, NEW_KEY], texts, target, f"{base}/lake", f"{base}/bad", ledger)

    lines.filter("doc_id % 2 = 0").select("value").write.text(f"{base}/in")
    try:
        run(DyingLedger(s.spark, f"{base}/ledger"))
    except Lost:
        pass
    lines.filter("doc_id % 2 = 1").select("value").write.mode("append").text(f"{base}/in")
    ledger = FileLedger(s.spark, f"{base}/ledger")
    while run(ledger):
        pass
    good = ledger.read(f"{base}/lake", target).select(F.lit("good").alias("reason"), "doc_id")
    bad = ledger.read(f"{base}/bad", T.StructType.fromDDL("_reason string")).select(F.col("_reason").alias("reason"), F.lit(None).cast("long").alias("doc_id"))
    return good.unionByName(bad).groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids"))


# ---- trees -------------------------------------------------------------------


@query("upline_closure")
def _(s: Star) -> DataFrame:
    """Every member with each of its uplines and their distance, from sponsor edges alone."""
    forest, _ = lineage.split_cycles(s.users(), "tree_user_id", "sponsor_id")
    return lineage.ancestors(forest).select(F.col("id").alias("tree_user_id"), F.col("ancestor").alias("upline_id"), "distance")


@query("nested_sets")
def _(s: Star) -> DataFrame:
    """Nested-set intervals of the sponsor tree, with the orders' value summed over each subtree by its range."""
    forest, _ = lineage.split_cycles(s.users(), "tree_user_id", "sponsor_id")
    found = cut(lineage.nested_sets(forest), "intervals")
    sums = lineage.subtree_sums(found, s.orders().withColumnRenamed("commission_user_id", "id"), {"orders": F.lit(1).cast("long"), "value": F.col("total").cast("decimal(29,4)")})
    return found.join(sums, "id").select("id", "depth", "size", "lft", "rgt", "orders", "value")


# ---- range joins -------------------------------------------------------------


@query("elapsed_time_pairs")
def _(s: Star) -> DataFrame:
    """Downline members paired, row by row, with the uplines within whose first 30 days they signed up."""
    users = s.users().select("client", "tree_user_id", "created")
    member = users.withColumnRenamed("created", "joined")
    points = s.upline().join(member, "tree_user_id").select("client", "upline_id", "tree_user_id", "joined")
    spans = users.select("client", F.col("tree_user_id").alias("upline_id"), F.col("created").alias("low"), (F.col("created") + F.expr("INTERVAL 30 DAYS")).alias("high"))
    pairs = ranges.within(points, spans, ["client", "upline_id"], "joined", "low", "high")
    days = F.datediff("joined", "low").cast("long")
    return pairs.groupBy("client", "upline_id").agg(F.count("*").alias("members"), F.sum(days).alias("days"), F.max("joined").alias("last"))


@query("logins_before_first_order")
def _(s: Star) -> DataFrame:
    """Logins inside the span from a user's sign-up to the first order, by user."""
    first = s.orders().groupBy("tree_user_id").agg(F.min("order_date").alias("high"))
    spans = s.users().join(first, "tree_user_id").select(F.col("tree_user_id").alias("user_id"), F.col("created").alias("low"), "high")
    pairs = ranges.within(s.logins().select("user_id", "id", "created_at"), spans, ["user_id"], "created_at", "low", "high")
    return pairs.groupBy("user_id").agg(F.count("*").alias("logins"), F.min("created_at").alias("first"))
