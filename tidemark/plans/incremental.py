"""High-water marks and idempotent window runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.versions import INGESTED, latest_by, union_all
from tidemark.sources.files import exists

# Start of time for a target never run. Fixed value.
START = "1970-01-01 00:00:00"

MARK_SCHEMA = T.StructType(
    [
        T.StructField("dag_id", T.StringType(), False),
        T.StructField("table", T.StringType(), False),
        T.StructField("checkpoint", T.StringType(), False),
        T.StructField("committed_at", T.TimestampType(), False),
    ]
)
PLAN_SCHEMA = T.StructType([*MARK_SCHEMA.fields[:-1], T.StructField("first", T.StringType(), False), MARK_SCHEMA.fields[-1]])


def upper_bound(sources: Mapping[str, DataFrame], lower) -> DataFrame:
    """One row ``last``: the newest ingest time of all sources from ``lower`` on.

    The bound is inclusive, so the boundary row counts again; NULL where nothing
    is there. A maximum sends one row per task, however many rows there are.
    """
    newest = union_all(
        df.filter(F.col(INGESTED) >= F.lit(lower).cast(df.schema[INGESTED].dataType)).select(INGESTED) for df in sources.values()
    )
    return newest.agg(F.max(INGESTED).alias("last"))


@dataclass(frozen=True)
class Window:
    first: str
    last: str | None

    @property
    def has_data(self) -> bool:
        return self.last is not None


class Marks:
    """Checkpoint table: one append per commit, the latest row per (job, table) counts.

    Commits are small atomic appends, so a run that dies leaves the old mark. A
    window is written down as planned before it is run; while its lower bound is
    still the mark it has not been committed, and the next run takes it up again
    with the same upper bound, whatever has arrived since.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _latest(self, path: str, schema: T.StructType) -> DataFrame:
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema).drop("committed_at")
        log = self.spark.read.schema(schema).parquet(path)
        return latest_by(log, ["dag_id", "table"], [F.desc("committed_at"), F.desc("checkpoint")]).drop("committed_at")

    def _append(self, path: str, schema: T.StructType, *values: str) -> None:
        row = (*values, datetime.now(timezone.utc))
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)

    def current(self) -> DataFrame:
        return self._latest(self.path, MARK_SCHEMA)

    def get(self, job: str, table: str) -> str:
        row = self.current().filter((F.col("dag_id") == job) & (F.col("table") == table)).first()
        return row["checkpoint"] if row else START

    def set(self, job: str, table: str, window: Window) -> None:
        """Commit the window's upper bound; nothing happens without one."""
        if window.has_data:
            self._append(self.path, MARK_SCHEMA, job, table, window.last)

    def set_all(self, job: str, windows: Mapping[str, Window]) -> None:
        """Commit the upper bounds of several tables at once."""
        now = datetime.now(timezone.utc)
        rows = [(job, t, w.last, now) for t, w in windows.items() if w.has_data]
        if rows:
            self.spark.createDataFrame(rows, MARK_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def planned_windows(self, job: str, tables: Mapping[str, DataFrame]) -> dict[str, Window]:
        """``planned_window`` of several tables, each its own source: the marks are read once, the upper bounds of all
        found in one job, and new plans written in one append."""
        plans = f"{self.path.rstrip('/')}-planned"
        mine = F.col("dag_id") == job
        marks = {r["table"]: r["checkpoint"] for r in self.current().filter(mine).collect()}
        lower = {t: marks.get(t, START) for t in tables}
        opened = {r["table"]: r for r in self._latest(plans, PLAN_SCHEMA).filter(mine).collect()}
        found = {
            t: Window(r["first"], r["checkpoint"]) for t, r in opened.items()
            if t in lower and r["first"] == lower[t] and r["checkpoint"] != r["first"]
        }
        new = [t for t in tables if t not in found]
        if new:
            bounds = union_all(
                upper_bound({t: tables[t]}, lower[t]).select(F.lit(t).alias("table"), F.col("last").cast("string").alias("last")) for t in new
            )
            made = {r["table"]: Window(lower[r["table"]], r["last"]) for r in bounds.collect()}
            now = datetime.now(timezone.utc)
            rows = [(job, t, w.last, w.first, now) for t, w in made.items() if w.has_data]
            if rows:
                self.spark.createDataFrame(rows, PLAN_SCHEMA).coalesce(1).write.mode("append").parquet(plans)
            found |= made
        return {t: found[t] for t in tables}

    def next_window(self, job: str, table: str, sources: Mapping[str, DataFrame]) -> Window:
        lower = self.get(job, table)
        last = upper_bound(sources, lower).select(F.col("last").cast("string")).first()["last"]
        return Window(lower, last)

    def planned_window(self, job: str, table: str, sources: Mapping[str, DataFrame]) -> Window:
        """The window an unfinished run has planned, else the next one, which is then written down as planned."""
        plans = f"{self.path.rstrip('/')}-planned"
        open_plan = self._latest(plans, PLAN_SCHEMA).filter((F.col("dag_id") == job) & (F.col("table") == table)).first()
        if open_plan and open_plan["first"] == self.get(job, table) and open_plan["checkpoint"] != open_plan["first"]:
            return Window(open_plan["first"], open_plan["checkpoint"])
        window = self.next_window(job, table, sources)
        if window.has_data:
            self._append(plans, PLAN_SCHEMA, job, table, window.last, window.first)
        return window


def window_name(window: Window) -> str:
    """Folder name of a window's output."""
    plain = str.maketrans({" ": "T", ":": "-"})
    return f"window={window.first.translate(plain)}_{window.last.translate(plain)}"


def run_window(
    marks: Marks, job: str, table: str, sources: Mapping[str, DataFrame], build: Callable[[str, str], DataFrame], target: str,
) -> Window:
    """Run one window: plan it, build, write to the window's own folder, then commit.

    A run that fails before the commit is repeated over the planned window and
    overwrites the same folder, even if newer rows have arrived in between; those
    belong to the window after it.
    """
    window = marks.planned_window(job, table, sources)
    if window.has_data:
        build(window.first, window.last).write.mode("overwrite").parquet(f"{target}/{window_name(window)}")
        marks.set(job, table, window)
    return window
