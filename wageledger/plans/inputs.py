"""What the registered queries share: staged order records, the times of their loads, and plain output columns."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wageledger.operators import dimensions, lookups, staging
from wageledger.sources.order_ledger import order_raw

Query = Callable[[SparkSession, str], DataFrame]

# The state of the raw table after two of its four daily loads.
AS_OF = datetime(2025, 1, 3, tzinfo=UTC)
RUN_TS = datetime(2025, 2, 1, tzinfo=UTC)
YEARS = (1996, 1997, 1998, 1999, 2000)


def rounded(column: str, digits: int) -> Column:
    return F.round(column, digits).alias(column)


def plain(df: DataFrame, digits: int = 2) -> DataFrame:
    """Dates and times as text, doubles rounded."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DoubleType):
            out.append(rounded(field.name, digits))
        elif isinstance(field.dataType, T.DateType):
            out.append(F.date_format(field.name, "yyyy-MM-dd").alias(field.name))
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(field.name, "yyyy-MM-dd HH:mm:ss").alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def before(df: DataFrame) -> DataFrame:
    return df.where(F.col("raw_ingested_at") < F.lit(AS_OF))


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stage_records(order_raw(spark, folder))


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Records with keys: all the reports need that do not look at separations."""
    return lookups.derive_keys(staged(spark, folder))


def employees_as_of(stg: DataFrame) -> DataFrame:
    """The employee dimension as the last run before ``AS_OF`` left it."""
    return dimensions.dim_employee(before(stg), datetime(2025, 1, 2, 12, tzinfo=UTC))
