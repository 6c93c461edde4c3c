"""Which files a batch load has taken, so that a load that died can be repeated and nothing counts twice."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import exists

PLAN = "path string, length long, modified timestamp, load int"
DONE = "at timestamp, load int"


class Load(NamedTuple):
    """A numbered load and the files it takes."""

    number: int
    paths: list[str]

    def folder(self, table: str) -> str:
        """The load's own folder of a table: a repeat overwrites it, and readers see the number as ``load``."""
        return f"{table.rstrip('/')}/load={self.number}"


class FileLedger:
    """Loads under ``path``: what each one takes, written before it runs, and which are done, written after its output.

    A load that is planned and not done is taken up again with the same files, whatever has arrived since. A file is
    known by its path, length and time of change, so a file sent again under its old name is a new one. One loader at
    a time is assumed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self, kind: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{kind}"
        return self.spark.read.schema(schema).parquet(folder) if exists(self.spark, folder) else self.spark.createDataFrame([], schema)

    def planned(self) -> DataFrame:
        return self._log("plan", PLAN)

    def done(self) -> DataFrame:
        return self._log("done", DONE)

    def begin(self, folder: str, prefix: str = "", suffix: str = "") -> Load | None:
        """The open load, else a new one of all files in the folder that no load has taken; None if there is neither."""
        planned = self.planned()
        waiting = planned.join(self.done(), "load", "left_anti")
        number = waiting.agg(F.min("load")).first()[0]
        if number is None:
            if not exists(self.spark, folder):
                return None
            name = F.element_at(F.split("path", "/"), -1)
            there = self.spark.read.format("binaryFile").load(folder).select("path", "length", F.col("modificationTime").alias("modified"))
            there = there.filter(name.startswith(prefix) & name.endswith(suffix))
            new = there.join(planned, ["path", "length", "modified"], "left_anti")
            if new.isEmpty():
                return None
            number = (planned.agg(F.max("load")).first()[0] or 0) + 1
            new.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/plan/load={number}")
            waiting = self.planned()
        return Load(number, sorted(r["path"] for r in waiting.filter(F.col("load") == number).select("path").collect()))

    def commit(self, load: Load) -> None:
        """Name the load as done; its output counts from now on."""
        row = self.spark.createDataFrame([(datetime.now(timezone.utc),)], "at timestamp")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/done/load={load.number}")

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """Rows of a table's finished loads; what a load that died has left is not among them."""
        loads = [r["load"] for r in self.done().select("load").orderBy("load").collect()]
        if not loads:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{table.rstrip('/')}/load={n}" for n in loads))
