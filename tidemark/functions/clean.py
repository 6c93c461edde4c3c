"""Schema-driven row cleaning, generated as column expressions on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import codec, dates

ZERO_DATE = "0000-00-00"
EPOCH_EVENT = "z/0"


def stamp(df: DataFrame, column: str = "ingested_at") -> DataFrame:
    """Processing time, one instant per query."""
    return df.withColumn(column, F.current_timestamp())


def enrich(df: DataFrame, tenant: str) -> DataFrame:
    """Turn a raw tenant copy into version rows."""
    return df.withColumns(
        {"client": F.lit(tenant), "event_id": F.lit(EPOCH_EVENT), "ingested_at": F.current_timestamp()}
    )


def tap(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The rows unchanged, and what is counted about them as they pass; ``get`` it after the action that reads them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(n) for n, m in metrics.items())), seen


def _is_temporal(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _as_text(value: Column, kind: T.DataType, pattern: str | None) -> Column:
    return value.cast("string") if pattern is None else F.date_format(value, pattern)


def _scrubbed(value: Column, kind: T.DataType, pattern: str | None) -> Column:
    if isinstance(kind, T.ArrayType):
        if not isinstance(kind.elementType, T.StructType):
            raise TypeError("list elements must be records")
        return F.transform(value, lambda e: _scrubbed(e, kind.elementType, pattern))
    if isinstance(kind, T.StructType):
        inner = F.struct(*(_scrubbed(value[f.name], f.dataType, pattern).alias(f.name) for f in kind.fields))
        return F.when(value.isNotNull(), inner)
    if isinstance(kind, T.StringType):
        return F.when(~value.contains(ZERO_DATE), value)
    if _is_temporal(kind):
        return _as_text(value, kind, pattern)
    return value


def stringify_temporals(df: DataFrame, pattern: str | None = None) -> DataFrame:
    """Zero dates to NULL, dates and timestamps to text, at every depth."""
    return df.select(*(_scrubbed(F.col(f"`{f.name}`"), f.dataType, pattern).alias(f.name) for f in df.schema.fields))


def _coerced(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda e: _coerced(e, have.elementType, want.elementType))
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        inner = [
            (_coerced(value[f.name], have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*inner))
    if isinstance(have, T.StringType):
        if isinstance(want, T.TimestampNTZType):
            return dates.parse_wall_time(value)
        if isinstance(want, T.DateType):
            return F.to_date(dates.parse_wall_time(value))
        if isinstance(want, T.TimestampType):
            return dates.parse_instant(value)
        if not isinstance(want, T.StringType):
            return value.try_cast(want)
    return value.cast(want)


def coerce(df: DataFrame, schema: T.StructType, rejects: str | None = None) -> DataFrame:
    """Convert to the target schema; columns the data lacks become NULL.

    Text that does not parse becomes NULL; with ``rejects`` the names of such
    top-level columns are listed in that column.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    converted = {
        f.name: _coerced(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        for f in schema.fields
    }
    out = [c.alias(name) for name, c in converted.items()]
    if rejects:
        failed = [
            F.when(F.col(f"`{n}`").isNotNull() & converted[n].isNull(), F.lit(n))
            for n in converted
            if n in have and isinstance(have[n], T.StringType)
        ]
        out.append(F.array_compact(F.array(*failed)).alias(rejects) if failed else F.array().cast("array<string>").alias(rejects))
    return df.select(*out)


def clean_relational(df: DataFrame) -> DataFrame:
    """Rows of a relational table as text-safe values: decimals and temporals to
    text, zero dates to NULL, long texts compressed."""

    def cleaned(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType) or _is_temporal(field.dataType):
            return value.cast("string")
        if isinstance(field.dataType, T.StringType):
            return codec.deflate_long(F.when(~value.contains(ZERO_DATE), value))
        return value

    return df.select(*(cleaned(f).alias(f.name) for f in df.schema.fields))


def _json_value(value: Column, kind: T.DataType) -> Column:
    """One JSON value as text, NULL for SQL NULL."""
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("string")
    if isinstance(kind, T.IntegralType):
        return value.cast("string")
    wrapped = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.when(value.isNotNull(), F.substring(wrapped, F.lit(6), F.length(wrapped) - 6))


def to_ndjson(df: DataFrame, column: str = "value") -> DataFrame:
    """One JSON text per row: NULL becomes ``""`` in every top-level field, booleans 0/1."""
    parts = []
    for i, field in enumerate(df.schema.fields):
        label = ("{" if i == 0 else ", ") + f'"{field.name}": '
        parts += [F.lit(label), F.coalesce(_json_value(F.col(f"`{field.name}`"), field.dataType), F.lit('""'))]
    return df.select(F.concat(*parts, F.lit("}")).alias(column))


def parse_json(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON lines to columns; a line that is no record is kept in ``_corrupt``."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(column), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return df.withColumn("_r", parsed).select(*(c for c in df.columns if c != column), "_r.*")


LINE, REASON = "_line", "_reason"
SEALED = "_sealed"


def checked(lines: DataFrame, record: T.StructType, target: T.StructType, column: str = "value") -> DataFrame:
    """JSON lines as rows of ``target``, with the line as it came and, where it is bad, the reason why.

    Bad is a line that is no record, one with a value that is not of its column's
    type (a zero date is a missing date, not a bad one), and one without a column
    the target requires. ``record`` is the record's schema as text fields. Where the
    lines carry ``SEALED``, the text before it was decrypted, those that no key has
    opened are bad and kept as they came.
    """
    sealed = F.col(SEALED) if SEALED in lines.columns else F.lit(None).cast("string")
    kept = F.coalesce(F.col(column), sealed)
    parsed = parse_json(lines.select(column, kept.alias(LINE), (F.col(column).isNull() & sealed.isNotNull()).alias("_closed")), record, column)
    texts = [f.name for f in record.fields if isinstance(f.dataType, T.StringType)]
    dated = parsed.withColumns({c: F.when(~F.col(c).contains(ZERO_DATE), F.col(c)) for c in texts})
    carried = T.StructType([*target.fields, T.StructField(LINE, T.StringType()), T.StructField("_corrupt", T.StringType()), T.StructField("_closed", T.BooleanType())])
    rows = coerce(dated, carried, rejects="_failed")
    lacking = [F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in target.fields if not f.nullable]
    broken = F.col("_corrupt").isNotNull() | (F.trim(LINE) == "")
    closed = F.col("_closed")
    typed = F.when(~broken & ~closed & (F.size("_failed") > 0), F.concat(F.lit("not of its type: "), F.array_join("_failed", ",")))
    without = F.array_join(F.array_compact(F.array(*lacking)), ",") if lacking else F.lit("")
    missing = F.when(~broken & ~closed & (without != ""), F.concat(F.lit("without "), without))
    reason = F.concat_ws("; ", F.when(closed, "no key opens it").when(broken, "not a record"), typed, missing)
    return rows.withColumn(REASON, F.nullif(reason, F.lit(""))).drop("_corrupt", "_failed", "_closed")


def accepted(rows: DataFrame, strict: bool = False) -> DataFrame:
    """The good rows of ``checked``; with ``strict`` a bad one stops the job and is named in the error."""
    if not strict:
        return rows.filter(F.col(REASON).isNull()).drop(LINE, REASON)
    first = rows.columns[0]
    stop = F.raise_error(F.concat(F.lit("bad line, "), F.col(REASON), F.lit(": "), F.substring(LINE, 1, 200)))
    return rows.withColumn(first, F.when(F.col(REASON).isNotNull(), stop).otherwise(F.col(first))).drop(LINE, REASON)


def rejected(rows: DataFrame) -> DataFrame:
    """``_line, _reason, rejected_at`` of the bad rows: the layout of every reject table."""
    return stamp(rows.filter(F.col(REASON).isNotNull()).select(LINE, REASON), "rejected_at")
