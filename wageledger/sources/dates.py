"""Generated date ranges and the calendar dimension."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wageledger.functions.dates import calendar_fields

# The default calendar, both ends included.
CALENDAR_START = date(2025, 1, 1)
CALENDAR_END = date(2030, 1, 1)


def _days(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("day")


def date_range(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, ``end`` included."""
    return spark.range(1).select(_days(F.lit(start), F.lit(end)))


def date_range_of(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last day found in ``column``."""
    bounds = df.agg(F.min(F.to_date(column)).alias("first"), F.max(F.to_date(column)).alias("last"))
    return bounds.select(_days(F.col("first"), F.col("last")))


def calendar(days: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Calendar attributes for every ``day``, with the audit time if given."""
    out = days.select(*[c.alias(name) for name, c in calendar_fields(F.col("day")).items()])
    return out if run_ts is None else out.withColumn("dbt_updated_at", F.lit(run_ts))
