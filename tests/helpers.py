"""Small staged records for tests."""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

STAGED = (
    "fiscal_year long, name_hash string, agency_name string, job_title string, department_name string, "
    "pay_basis string, start_date date, separation_date date, record_updated_at date, hourly_rate double, "
    "regular_pay double, overtime_pay double, cash_outs double, retro_pay double, other_pay double, "
    "total_earnings double, source_file string, raw_ingested_at timestamp"
)
DEFAULTS = {
    "fiscal_year": 2025,
    "name_hash": "n1",
    "agency_name": "BUS",
    "job_title": "DRIVER",
    "department_name": "D",
    "pay_basis": "HOURLY",
    "start_date": date(2025, 2, 1),
    "separation_date": None,
    "record_updated_at": date(2025, 6, 1),
    "hourly_rate": 20.0,
    "regular_pay": 100.0,
    "overtime_pay": 20.0,
    "cash_outs": 3.0,
    "retro_pay": 4.0,
    "other_pay": 5.0,
    "total_earnings": 132.0,
    "source_file": "payroll_1.csv",
    "raw_ingested_at": datetime(2025, 7, 1),
}


def staged(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame([tuple({**DEFAULTS, **r}.values()) for r in rows], STAGED)


def dicts(df: DataFrame) -> list[dict]:
    return sorted((r.asDict() for r in df.collect()), key=repr)
