"""Declared schemas: required columns, evolution, alignment."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns every table of a tier must have, by the table's partitioning. Fixed values.
VERSION_FIELDS = [
    T.StructField("event_id", T.StringType(), False),
    T.StructField("ingested_at", T.TimestampType(), False),
]
TENANT_FIELD = T.StructField("client", T.StringType(), False)
PARTITION_FIELD = T.StructField("client_partition_id", T.LongType(), False)


def from_json(text: str) -> T.StructType:
    """Schema from its JSON text: Spark's own form, or ``{"fields": [{name, type, mode, fields}]}``."""
    loaded = json.loads(text)
    if loaded.get("type") == "struct":
        return T.StructType.fromJson(loaded)
    return T.StructType([_field(f) for f in loaded["fields"]])


# Declared type names and their Spark types. Fixed values.
DECLARED_TYPES = {
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "NUMERIC": T.DecimalType(19, 4),
    "FLOAT": T.DoubleType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "BYTES": T.BinaryType(),
}


def _field(declared: dict) -> T.StructField:
    if declared["type"] == "RECORD":
        kind: T.DataType = T.StructType([_field(f) for f in declared["fields"]])
    else:
        kind = DECLARED_TYPES[declared["type"]]
    mode = declared.get("mode", "NULLABLE")
    if mode == "REPEATED":
        return T.StructField(declared["name"], T.ArrayType(kind), True)
    return T.StructField(declared["name"], kind, mode != "REQUIRED")


def with_required(schema: T.StructType, *required: T.StructField) -> T.StructType:
    """Add the required columns a schema lacks."""
    have = set(schema.names)
    return T.StructType([*schema.fields, *(f for f in required if f.name not in have)])


def lake_schema(raw: T.StructType) -> T.StructType:
    """Raw schema plus tenant and version columns."""
    return with_required(raw, TENANT_FIELD, *VERSION_FIELDS)


def evolve(schema: T.StructType, *added: T.StructField) -> T.StructType:
    """Add columns if absent; new columns are nullable."""
    return with_required(schema, *(T.StructField(f.name, f.dataType, True) for f in added))


def relax(schema: T.StructType, *names: str) -> T.StructType:
    """Make required columns nullable."""
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable or f.name in names) for f in schema.fields])


def without(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])


def clone(schemas: dict[str, T.StructType]) -> dict[str, T.StructType]:
    """Independent copies of all schemas of a dataset."""
    return {name: T.StructType.fromJson(json.loads(s.json())) for name, s in schemas.items()}


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the schema's order and types; those the data lacks are NULL."""
    return df.select(
        *(
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def missing_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that lack a value the schema requires."""
    lacking = F.lit(False)
    for f in schema.fields:
        if not f.nullable:
            lacking = lacking | (F.col(f.name).isNull() if f.name in df.columns else F.lit(True))
    return df.filter(lacking)
