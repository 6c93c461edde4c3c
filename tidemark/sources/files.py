"""File sources: listing, line text, CSV, encrypted lines."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import SEALED
from tidemark.functions.codec import decrypt_line

# Number at the end of a file name, by which files are ordered. Fixed value.
SEQUENCE = r"[-*](\d+)$"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder is there (Spark checks paths when it resolves a read)."""
    try:
        spark.read.schema("value string").text(path)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file of whatever store the path names; False where nothing is there."""
    context = spark.sparkContext
    there = context._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(context._jsc.hadoopConfiguration()).delete(there, True)


def file_sequence(name: Column, pattern: str = SEQUENCE) -> Column:
    """Numeric suffix of a file name; NULL without one."""
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).try_cast("long")


def list_files(
    spark: SparkSession, folder: str, starts_with: str = "", contains: str = "", pattern: str = SEQUENCE, key: Callable[[Column], Column] | None = None
) -> DataFrame:
    """``path, file_name, file_seq`` of files directly in the folder, by sequence then name.

    ``key`` makes the sort key from the name where the number at its end is not
    wanted. Listing is Spark's own; file contents are not read.
    """
    files = spark.read.format("binaryFile").load(folder).select("path")
    named = files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))
    wanted = named.filter(F.col("file_name").startswith(starts_with) & F.col("file_name").contains(contains))
    sequence = key(F.col("file_name")) if key else file_sequence(F.col("file_name"), pattern)
    return wanted.withColumn("file_seq", sequence).orderBy(F.asc_nulls_last("file_seq"), "file_name")


def has_file(spark: SparkSession, folder: str, prefix: str = "") -> bool:
    """Presence gate for a batch run."""
    return exists(spark, folder) and not list_files(spark, folder, prefix).isEmpty()


def read_lines(spark: SparkSession, paths: str | Sequence[str], name_glob: str | None = None) -> DataFrame:
    """``value, file_name, file_seq`` per line of all files."""
    reader = spark.read
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return with_file_order(reader.text(paths))


def with_file_order(lines: DataFrame) -> DataFrame:
    """Keep file name and sequence, so replays can be ordered without ordering the read."""
    name = F.col("_metadata.file_name")
    return lines.select("value", name.alias("file_name"), file_sequence(name).alias("file_seq"))


def decrypt_lines(lines: DataFrame, keys: Sequence[str], on_failure: str = "raise") -> DataFrame:
    """Replace ``value`` by its plain text.

    Lines no key opens raise, or with ``on_failure="null"`` stay as NULL for a
    reject table, with the line as it came in ``_sealed``.
    """
    text = decrypt_line(F.col("value"), keys)
    opened = lines.withColumn("_text", text)
    if on_failure != "raise":
        opened = opened.withColumn(SEALED, F.col("value"))
    if on_failure == "raise":
        checked = F.when(F.col("_text").isNotNull(), F.col("_text")).otherwise(
            F.raise_error(F.lit("no key decrypts a line"))
        )
    else:
        checked = F.col("_text")
    return opened.withColumn("value", checked).drop("_text")


PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("tree_user_id", T.LongType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("client_partner_id", T.StringType()),
        T.StructField("expirement_name", T.StringType()),
        T.StructField("processing_datetime", T.TimestampNTZType()),
    ]
)


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, header_mark: str | None = None) -> DataFrame:
    """CSV as text columns, headers (first field equals ``header_mark``) and blank lines dropped.

    Types are left to ``clean.coerce``, so a bad number is a reject, not a failure.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = spark.read.schema(text).option("header", "false").csv(paths)
    first = schema.fields[0].name
    return rows if header_mark is None else rows.filter(F.coalesce(F.col(first), F.lit("")) != header_mark)


RATING_SCHEMA = T.StructType(
    [T.StructField("product_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("rating", T.IntegerType())]
)


def read_ratings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Headerless ratings: product, user, rating 1..5."""
    return spark.read.schema(RATING_SCHEMA).csv(paths)
