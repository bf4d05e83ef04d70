"""Joins of the star schema.

No join carries a broadcast hint. Dimensions are read back from the tables they
were written to, so the optimizer knows their size in bytes and broadcasts the
ones under ``spark.sql.autoBroadcastJoinThreshold``; a larger dimension gets a
shuffled join, in which adaptive execution splits a hot key's partition.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wageledger.functions.keys import employee_key, payroll_key, surrogate_key
from wageledger.operators.dimensions import EMPLOYEE_KEYS, audited
from wageledger.operators.staging import MEASURES


def lookup_employee(stg: DataFrame, employees: DataFrame) -> DataFrame:
    """Add ``employee_key`` by name, agency, title and start date.

    Two missing start dates match; a missing name matches nobody and the record stays, without a key.
    """
    dim = employees.select("employee_key", *[F.col(c).alias(f"_{c}") for c in EMPLOYEE_KEYS])
    match = F.col("start_date").eqNullSafe(F.col("_start_date"))
    for c in ("name_hash", "agency_name", "job_title"):
        match = match & (F.col(c) == F.col(f"_{c}"))
    return stg.join(dim, match, "left").drop(*[f"_{c}" for c in EMPLOYEE_KEYS])


def lookup_dim(df: DataFrame, dim: DataFrame, label: str, key: str) -> DataFrame:
    """Add ``key`` by ``label``; a label the dimension lacks leaves the key NULL."""
    return df.join(dim.select(label, key), label, "left")


def derive_keys(stg: DataFrame) -> DataFrame:
    """Add the three foreign keys without any join or shuffle.

    Keys are functions of the labels, so for dimensions built from the same
    records this equals the lookups.
    """
    return stg.withColumns(
        {
            "employee_key": employee_key(*[F.col(c) for c in EMPLOYEE_KEYS]),
            "agency_key": surrogate_key(F.col("agency_name")),
            "job_title_key": surrogate_key(F.col("job_title")),
        }
    )


def lookup_keys(stg: DataFrame, employees: DataFrame, agencies: DataFrame, titles: DataFrame) -> DataFrame:
    """Add the three foreign keys by looking them up in the dimensions."""
    keyed = lookup_employee(stg, employees)
    keyed = lookup_dim(keyed, agencies, "agency_name", "agency_key")
    return lookup_dim(keyed, titles, "job_title", "job_title_key")


def fact_payroll(keyed: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """The fact table: one row per staged record, keys and measures only."""
    fact = keyed.select(
        payroll_key(*[F.col(c) for c in ("employee_key", "agency_key", "job_title_key", "fiscal_year")]).alias(
            "payroll_key"
        ),
        "employee_key",
        "agency_key",
        "job_title_key",
        "fiscal_year",
        *MEASURES,
        "record_updated_at",
        "raw_ingested_at",
    )
    return audited(fact, run_ts)


# Columns of the one big table, in order.
WIDE_COLUMNS = (
    "payroll_key",
    "employee_key",
    "agency_key",
    "job_title_key",
    "name_hash",
    "start_date",
    "separation_date",
    "pay_basis",
    "department_name",
    "agency_name",
    "job_title",
    "fiscal_year",
    "hourly_rate",
    "regular_pay",
    "overtime_pay",
    "total_earnings",
    "retro_pay",
    "cash_outs",
    "other_pay",
    "record_updated_at",
    "raw_ingested_at",
)


def denormalize(
    fact: DataFrame, employees: DataFrame, agencies: DataFrame, titles: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    """Fact rows with the attributes of their three dimensions; rows without a match stay."""
    people = employees.select(
        "employee_key", "name_hash", "start_date", "separation_date", "pay_basis", "department_name"
    )
    wide = (
        fact.drop("dbt_updated_at")
        .join(agencies.select("agency_key", "agency_name"), "agency_key", "left")
        .join(titles.select("job_title_key", "job_title"), "job_title_key", "left")
        .join(people, "employee_key", "left")
    )
    return audited(wide.select(*WIDE_COLUMNS), run_ts)


def wide_records(stg: DataFrame, employees: DataFrame) -> DataFrame:
    """The one big table straight from staged records, with a single join.

    Keys are derived, labels and start date are those of the record itself;
    only what the golden record decides comes from ``employees``.
    """
    keyed = derive_keys(stg).drop("separation_date", "pay_basis", "department_name")
    known = F.col("employee_key").isNotNull()
    decided = employees.select("employee_key", "separation_date", "pay_basis", "department_name")
    return (
        keyed.join(decided, "employee_key", "left")
        .withColumns(
            {
                "start_date": F.when(known, F.col("start_date")),
                "payroll_key": payroll_key(
                    *[F.col(c) for c in ("employee_key", "agency_key", "job_title_key", "fiscal_year")]
                ),
            }
        )
        .select(*WIDE_COLUMNS)
    )


def person_years(stg: DataFrame, employees: DataFrame) -> DataFrame:
    """Who was paid in which year, place and title, with the golden separation date.

    All that ``hr_dynamics`` reads of the wide records, without their repeats:
    they collapse before the join, so a person with a third of all rows brings
    one row per year and map task to it.
    """
    years = derive_keys(stg).select("fiscal_year", "agency_name", "job_title", "employee_key", "start_date").distinct()
    dated = years.join(employees.select("employee_key", "separation_date"), "employee_key", "left")
    return dated.withColumn("start_date", F.when(F.col("employee_key").isNotNull(), F.col("start_date")))
