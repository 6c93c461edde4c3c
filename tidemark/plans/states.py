"""Latest versions kept between windows, so that a refine job does not rank the whole history again.

For each lake table that the refine jobs look up by changed id there is a keyed table of latest versions, laid out by
that id. A window's rows are merged into the buckets they touch; a job then reads only the buckets of the ids that its
window has changed. Late events with an older id lose against what is there, as they do in the full history.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.versions import in_window
from tidemark.plans.incremental import START
from tidemark.sinks.keyed import KeyedTable

# (lake table, column it is looked up by): further columns of the row's key, beside the tenant. Fixed values.
STATES = {
    ("tree_users", "id"): (),
    ("users", "id"): (),
    ("users", "tree_user_id"): (),
    ("tree_orders", "id"): (),
    ("tree_order_items", "order_id"): ("id",),
    ("pyr_contacts", "id"): (),
    ("pyr_contact_emails", "contact_id"): ("email",),
    ("pyr_contact_phone_numbers", "contact_id"): ("unformatted_phone_number",),
    ("pyr_contacts_contact_categories", "contact_id"): ("contact_category_id",),
}


class StatefulLake(Mapping[str, DataFrame]):
    """Lake tables by name, and the latest versions of those in ``STATES`` under ``path``.

    ``advance`` takes the rows of a window into the states. A job over the window comes after it. Repeating a window
    changes nothing, as the rank of versions decides and not the order in which they come.
    """

    def __init__(self, spark: SparkSession, lake: Mapping[str, DataFrame], path: str, buckets: int = 64, names: Mapping[tuple[str, str], tuple] = STATES):
        self._lake = lake
        self.states = {
            (table, own): KeyedTable(spark, f"{path}/{table}-{own}", lake[table].schema, ["client", own, *rest], ["client", own], buckets)
            for (table, own), rest in names.items() if table in lake
        }

    def advance(self, first: str | None, last: str) -> None:
        """Merge the versions ingested in ``[first, last]``, or all up to ``last``, into every state."""
        for (table, _), state in self.states.items():
            state.merge(in_window(self._lake[table], first or START, last))

    def known(self, table: str, own: str, ids: DataFrame, key: str) -> DataFrame | None:
        """Latest versions of the entities in ``ids``; None where the table has no state by this column."""
        state = self.states.get((table, own))
        return state.rows_for(ids, {own: key}) if state else None

    def __getitem__(self, name: str) -> DataFrame:
        return self._lake[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._lake)

    def __len__(self) -> int:
        return len(self._lake)
