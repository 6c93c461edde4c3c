"""The nine conformed tables, built by their jobs and exported whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.adapters import Star
from tidemark.catalog import assembly
from tidemark.catalog.base import FIRST, LAST, query
from tidemark.catalog.refine import RULES, lake_tables, tenant_table
from tidemark.operators.versions import union_all
from tidemark.plans import incremental, load, refine
from tidemark.session import cut, work_dir

CREATED_AFTER = "1995-05-01"

# Per table: the row's key, the sizes of nested arrays to add up, and a column that is NULL in some rows.
READ_BACK = {
    "pii.users": ("tree_user_id", (), "birth_date"),
    "staging.emails": ("message_id", ("recipients",), "sender_tree_user_id"),
    "staging.flat_site_visitors": ("visitor_id", (), "tracking_code"),
    "staging.orders": ("order_id", ("products",), "shipping_city"),
    "staging.product_reviews": ("user_id", (), "product_discontinue_on"),
    "staging.sites": ("site_id", ("visitors", "analytics_tracking_codes"), "visitors"),
    "staging.tasks": ("id", (), "completed"),
    "staging.users": ("tree_user_id", (), "user_id"),
    "staging.contacts": ("id", ("emails", "phone_numbers", "categories"), "tree_user_id"),
}


def conformed(s: Star) -> dict[str, DataFrame]:
    """The frames of the export list, as the jobs build them; those without an ingest time are stamped with one."""
    lake, tenants = lake_tables(s), tenant_table(s)
    stamp = F.lit("1997-01-01").cast("timestamp_ntz")

    def copied(df: DataFrame, **renamed: str) -> DataFrame:
        return df.withColumnsRenamed(renamed).withColumn("ingested_at", stamp)

    return {
        "pii.users": refine.pii_users(lake, tenants, FIRST, LAST),
        "staging.emails": copied(assembly.emails(s), message_created_at="created"),
        "staging.flat_site_visitors": copied(assembly.visits(s)),
        "staging.orders": refine.staging_orders(lake, tenants, RULES, FIRST, LAST),
        "staging.product_reviews": copied(assembly.reviews(s)),
        "staging.sites": copied(assembly.sites(s)),
        "staging.tasks": copied(assembly.task_rows(s), created_at="created", completed_at="completed"),
        "staging.users": refine.staging_users(lake, tenants, RULES, FIRST, LAST),
        "staging.contacts": copied(refine.staging_contacts(lake, tenants, FIRST, LAST)),
    }


@query("export_nine_tables")
def _(s: Star) -> DataFrame:
    """Every table of the export list written as numbered NDJSON shards with its creation filter, and read back."""
    folder = work_dir(s.spark, "nine")
    frames = {t: cut(df, "conformed") for t, df in conformed(s).items()}
    load.export_tables(incremental.Marks(s.spark, f"{folder}/marks"), "export", frames, folder, created_after=CREATED_AFTER)
    found = []
    for table, (key, nested, blank) in READ_BACK.items():
        lists = "".join(f", {c} array<string>" for c in nested if c != blank)
        back = s.spark.read.schema(f"{key} long, {blank} string{lists}").json(f"{folder}/{table}")
        sizes = [F.coalesce(F.size(F.from_json(c, "array<string>") if c == blank else F.col(c)), F.lit(0)) for c in nested]
        found.append(back.agg(
            F.lit(table).alias("table"), F.count("*").alias("n"), F.sum(key).alias("keys"),
            F.coalesce(F.sum(sum(sizes, F.lit(0))), F.lit(0)).cast("long").alias("nested"), F.count_if((F.col(blank) == "") | F.col(blank).isNull()).alias("blank")))
    return union_all(found)
