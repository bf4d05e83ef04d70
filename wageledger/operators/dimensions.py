"""Dimensions: distinct labels with keys, and one row per person and position."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wageledger.functions.keys import employee_key, surrogate_key

EMPLOYEE_KEYS = ("name_hash", "agency_name", "job_title", "start_date")
OPEN_END = date(9999, 12, 31)


def audited(df: DataFrame, run_ts: datetime | None) -> DataFrame:
    return df if run_ts is None else df.withColumn("dbt_updated_at", F.lit(run_ts).cast("timestamp"))


def build_dim(stg: DataFrame, label: str, key: str, run_ts: datetime | None = None) -> DataFrame:
    """Distinct non-NULL values of ``label`` with a surrogate key."""
    values = stg.where(F.col(label).isNotNull()).select(label).distinct()
    return audited(values.select(surrogate_key(F.col(label)).alias(key), label), run_ts)


def dim_agency(stg: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return build_dim(stg, "agency_name", "agency_key", run_ts)


def dim_job_title(stg: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return build_dim(stg, "job_title", "job_title_key", run_ts)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in ``order``; NULL keys form a group of their own.

    Filtering the row number right above the window lets Spark keep one row
    per key in each map task before the shuffle, so a hot key sends at most
    one row per task however many rows it has.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def employee_order() -> list[Column]:
    """Open records before closed ones, later separations first, then the latest load.

    Files of one load count as loaded in the order of their names. The last
    three make the choice repeatable where records tie.
    """
    return [
        F.coalesce(F.col("separation_date"), F.lit(OPEN_END)).desc(),
        F.col("raw_ingested_at").desc_nulls_last(),
        F.col("source_file").desc_nulls_last(),
        F.col("department_name").asc_nulls_last(),
        F.col("pay_basis").asc_nulls_last(),
        F.col("separation_date").asc_nulls_last(),
    ]


def dim_employee(stg: DataFrame, run_ts: datetime | None = None, order: Sequence[Column] | None = None) -> DataFrame:
    """The golden record of each name, agency, title and start date."""
    columns = [*EMPLOYEE_KEYS, "separation_date", "department_name", "pay_basis"]
    latest = latest_per_key(stg.select(*columns, "raw_ingested_at", "source_file"), EMPLOYEE_KEYS, order or employee_order())
    people = latest.select(
        employee_key(*[F.col(c) for c in EMPLOYEE_KEYS]).alias("employee_key"),
        "name_hash",
        "start_date",
        "separation_date",
        "agency_name",
        "department_name",
        "job_title",
        "pay_basis",
    )
    return audited(people, run_ts)
