"""Session settings the jobs rely on, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Semantics (UTC) and skew handling. Partition counts stay with the cluster: AQE
# coalesces shuffles to the advisory size and splits partitions of a hot key.
# Join sides are broadcast by Spark only, under its own size check
# (autoBroadcastJoinThreshold at plan time, measured shuffle size at run time);
# no job gives a broadcast hint.
RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where that costs one more shuffle of partial aggregates
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # streaming state off the heap, its changes kept with the checkpoint
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def share_code(spark: SparkSession) -> None:
    """Let Python workers find the package from whatever folder the session was started. On a cluster the executors
    have it installed; a folder that is not there is ignored."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options on an existing session."""
    share_code(spark)
    for name, value in RUNTIME_OPTIONS.items():
        spark.conf.set(name, value)
    return spark


def build(app: str = "tidemark", master: str | None = None, **options: str) -> SparkSession:
    """Create (or get) a session with the options above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_OPTIONS, **options}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the cluster's shared ``spark.checkpoint.dir``.

    Only where the session names none (tests, one machine) is a local folder used.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", ""
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Ends the lineage with data that outlives any executor, so a frame used
    several times is computed once. Compressed well, as wide rows go through it.
    """
    return _written(df, work_dir(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """``cut`` for the results of a loop, of which only the newest is read again: the shuffle files of a step go as soon as
    it is written, and so does the result of the step before, which else stay on disk until the driver collects garbage
    or the session ends."""

    CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, name: str):
        self.name, self.last = name, None

    def cut(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path, before = work_dir(spark, self.name), spark.conf.get(self.CLEAN)
        spark.conf.set(self.CLEAN, "true")
        try:
            found = _written(df, path)
        finally:
            spark.conf.set(self.CLEAN, before)
        if self.last:
            old = spark._jvm.org.apache.hadoop.fs.Path(self.last)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        self.last = path
        return found


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a source scan at least as many partitions as there are cores.

    A file with one row group is one task, whatever its size. Only where the scan
    has too few partitions is it shuffled, before costly work per row; tables of
    many files stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def local_table(spark: SparkSession, rows: list[dict], schema) -> DataFrame:
    """A small configuration table whose size Spark knows (a local relation)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)), schema)
