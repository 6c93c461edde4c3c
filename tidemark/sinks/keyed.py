"""A table with one current row per key, changed bucket by bucket.

Rows lie in buckets by a hash of some of their key columns. A version of the table is a manifest: which folder holds each
bucket, and which folders of changes are not folded in yet. A merge reads and rewrites only the buckets its rows fall
into and then writes the next manifest; files of other buckets stay where they are. The manifest is one file that
appears whole or not at all, so a run that dies before it leaves the old version, and a repeat overwrites what the
dead run has left. One writer at a time is assumed; readers keep the version they have opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.versions import latest_by
from tidemark.schema import align
from tidemark.session import cut
from tidemark.sources.files import exists, remove

MANIFEST = "kind string, bucket int, folder string, token long, layout string"
BUCKET = "_bucket"


@dataclass(frozen=True)
class Version:
    """Folders of a version, relative to the table: one for each bucket that has rows, and the open changes in order."""

    number: int
    buckets: dict[int, str]
    changes: tuple[str, ...]
    token: int | None


class KeyedTable:
    """``keys`` name a row, ``place`` (some of the keys, by default all) decides its bucket.

    ``order`` ranks the rows of a key, the first stays: by default the newest version. ``buckets`` is fixed when the
    table is created; choose it so that a bucket is a task's worth of rows.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], place: Sequence[str] = (),
        buckets: int = 64, order: Sequence[Column] | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.place, self.buckets, self.order = list(keys), list(place or keys), buckets, order
        self.layout = f"{buckets} by {','.join(self.place)}"
        if not set(self.place) <= set(self.keys):
            raise ValueError("rows of one key would lie in several buckets")

    # ---- versions ----------------------------------------------------------

    def version(self) -> Version:
        """The newest version that is complete; number 0, without rows, before the first."""
        folder = f"{self.path}/manifest"
        if not exists(self.spark, folder):
            return Version(0, {}, (), None)
        log = self.spark.read.schema(f"{MANIFEST}, version int").json(folder)
        rows = log.join(log.agg(F.max("version").alias("version")), "version").collect()
        if any(r["layout"] not in (None, self.layout) for r in rows):
            raise ValueError(f"the table has another layout than {self.layout}")
        changes = sorted((r["bucket"], r["folder"]) for r in rows if r["kind"] == "change")
        return Version(
            rows[0]["version"], {r["bucket"]: r["folder"] for r in rows if r["kind"] == "base"}, tuple(f for _, f in changes),
            next(r["token"] for r in rows if r["kind"] == "table"),
        )

    def _commit(self, version: Version) -> None:
        rows = [("table", None, None, version.token, self.layout), *(("base", b, f, None, None) for b, f in sorted(version.buckets.items())),
                *(("change", i, f, None, None) for i, f in enumerate(version.changes))]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/version={version.number}")

    # ---- rows --------------------------------------------------------------

    def _bucket(self, *columns: Column) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int")

    def _read(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_by(rows, self.keys, self.order)

    def read(self) -> DataFrame:
        """The current row of every key."""
        version = self.version()
        base = self._read(list(version.buckets.values()))
        return self._latest(base.unionByName(self._read(version.changes))) if version.changes else base

    def rows_for(self, ids: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
        """Current rows whose ``place`` is among ``ids``; buckets without one are not read.

        ``names`` maps place columns to columns of ``ids`` where they are called otherwise.
        """
        names = names or {}
        kinds = {f.name: f.dataType for f in self.schema}
        wanted = ids.select(*(F.col(names.get(c, c)).cast(kinds[c]).alias(c) for c in self.place))
        version = self.version()
        touched = {r[0] for r in wanted.select(self._bucket(*(F.col(c) for c in self.place))).distinct().collect()}
        rows = self._read([f for b, f in version.buckets.items() if b in touched]).unionByName(self._read(version.changes))
        found = rows.join(wanted, self.place, "left_semi")
        return self._latest(found) if version.changes else found

    def _touched(self, rows: DataFrame) -> list[int]:
        """Buckets that rows fall into: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())

    # ---- changes -----------------------------------------------------------

    def merge(self, rows: DataFrame, token: int | None = None) -> Version:
        """Fold rows into the buckets they fall into; the rank decides between old and new rows of a key.

        A ``token`` that is not above the last one names changes the table has already: nothing happens then.
        """
        version = self.version()
        if token is not None and version.token is not None and token <= version.token:
            return version
        return self._fold(version, align(rows, self.schema), version.token if token is None else token)

    def append(self, rows: DataFrame, token: int | None = None) -> Version:
        """Keep rows as open changes, in a folder of their own; ``fold`` merges all open changes at once."""
        version = self.version()
        if token is not None and version.token is not None and token <= version.token:
            return version
        folder = f"changes/version={version.number + 1}"
        align(rows, self.schema).write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{folder}")
        done = Version(version.number + 1, version.buckets, (*version.changes, folder), version.token if token is None else token)
        self._commit(done)
        return done

    def fold(self) -> Version:
        """Merge the open changes into the buckets they fall into."""
        version = self.version()
        return self._fold(version, self.spark.createDataFrame([], self.schema), version.token) if version.changes else version

    def _fold(self, version: Version, rows: DataFrame, token: int | None) -> Version:
        # one row per key before anything is gathered by bucket, so a hot key sends one row per task
        new = self._latest(rows.unionByName(self._read(version.changes))).withColumn(BUCKET, self._bucket(*(F.col(c) for c in self.place)))
        new = cut(new, "changes")
        touched = self._touched(new)
        old = self._read([f for b, f in version.buckets.items() if b in touched])
        old = old.withColumn(BUCKET, self._bucket(*(F.col(c) for c in self.place)))
        both = old.unionByName(new).repartition(max(1, len(touched)), BUCKET)
        folder = f"data/version={version.number + 1}"
        merged = latest_by(both, [BUCKET, *self.keys], self.order).sortWithinPartitions(BUCKET, *self.keys)
        merged.write.mode("overwrite").option("compression", "zstd").partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        done = Version(version.number + 1, version.buckets | {b: f"{folder}/{BUCKET}={b}" for b in touched}, (), token)
        self._commit(done)
        return done

    def vacuum(self) -> list[str]:
        """Remove the folders that the newest version does not name, older manifests among them."""
        version = self.version()
        if not version.number:
            return []
        named = {f.split("/")[1] for f in (*version.buckets.values(), *version.changes)} | {f"version={version.number}"}
        gone = [f"{kind}/version={n}" for n in range(1, version.number) for kind in ("manifest", "data", "changes") if kind == "manifest" or f"version={n}" not in named]
        stale = {f for f in version.buckets.values()}
        for n in range(1, version.number):  # buckets that a later version has rewritten, in folders still in use
            if f"version={n}" in named:
                gone += [f"data/version={n}/{BUCKET}={b}" for b in range(self.buckets) if f"data/version={n}/{BUCKET}={b}" not in stale]
        return [f for f in gone if remove(self.spark, f"{self.path}/{f}")]
