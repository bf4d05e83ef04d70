"""Declared columns of the raw table and the JSON form of a schema."""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import types as T

# The columns of a landed file, in file order.
RAW_COLUMNS = (
    "Year",
    "name_hash",
    "Working_Agency",
    "Start_Date",
    "Separation_Date",
    "Title",
    "Department",
    "Pay_Basis",
    "Hourly_Rate",
    "Regular_Pay",
    "Overtime_Pay",
    "Cash_Outs",
    "Retro_Pay",
    "Other_Pay",
    "Total_Earnings",
    "Updated_At",
)
REQUIRED = ("name_hash",)

# Type names a JSON schema may use.
_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def landed_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), c not in REQUIRED) for c in RAW_COLUMNS])


def raw_schema(landed: T.StructType | None = None) -> T.StructType:
    """Landed columns and the audit columns; ``source_file`` is the partition column, so it is last."""
    schema = T.StructType(list((landed or landed_schema()).fields))
    return schema.add("raw_ingested_at", T.TimestampType()).add("source_file", T.StringType())


def schema_from_fields(fields: Iterable[dict]) -> T.StructType:
    """Field entries (name, type, mode, description) as a Spark schema."""
    out = T.StructType()
    for field in fields:
        kind = field.get("type", "STRING").upper()
        if kind not in _TYPES:
            raise ValueError(f"column {field['name']}: unsupported type {kind}")
        note = {"comment": field["description"]} if field.get("description") else None
        required = field.get("mode", "NULLABLE").upper() == "REQUIRED"
        out.add(T.StructField(field["name"], _TYPES[kind], not required, note))
    return out


def schema_from_json(path: str | Path) -> T.StructType:
    return schema_from_fields(json.loads(Path(path).read_text(encoding="utf-8")))
