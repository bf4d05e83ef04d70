"""Raw text to typed, cleaned records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wageledger.functions import clean_label, landed_name, safe_date, safe_double, safe_long, trim_space

# Raw column to staged column, by how it is converted.
LABELS = {
    "Working_Agency": "agency_name",
    "Title": "job_title",
    "Department": "department_name",
    "Pay_Basis": "pay_basis",
}
DATES = {"Start_Date": "start_date", "Separation_Date": "separation_date", "Updated_At": "record_updated_at"}
AMOUNTS = {
    "Hourly_Rate": "hourly_rate",
    "Regular_Pay": "regular_pay",
    "Overtime_Pay": "overtime_pay",
    "Cash_Outs": "cash_outs",
    "Retro_Pay": "retro_pay",
    "Other_Pay": "other_pay",
    "Total_Earnings": "total_earnings",
}
MEASURES = list(AMOUNTS.values())


def with_audit(df: DataFrame, run_ts: datetime, path: str = "landed_path") -> DataFrame:
    """Add source file name and ingestion time to landed rows, dropping the path."""
    return (
        df.withColumn("raw_ingested_at", F.lit(run_ts).cast("timestamp"))
        .withColumn("source_file", landed_name(F.col(path)))
        .drop(path)
    )


def with_file_stamps(audited: DataFrame, stamps: DataFrame) -> DataFrame:
    """Audited rows with the ingestion time of their own file, by ``source_file, stamp``; other files keep theirs.

    ``stamps`` holds one row per file of a load job, whose number is bounded.
    """
    rows = audited.join(F.broadcast(stamps), "source_file", "left")
    stamp = F.coalesce("stamp", "raw_ingested_at").alias("raw_ingested_at")
    return rows.select(*(stamp if c == "raw_ingested_at" else F.col(c) for c in audited.columns))


def stage_records(raw: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """One typed record per raw row; what cannot be parsed becomes NULL (dates, year) or 0 (amounts).

    A single projection: readers that need a few columns scan only those.
    """
    columns = {
        "fiscal_year": safe_long(F.col("Year")),
        "name_hash": trim_space(F.col("name_hash").cast("string")),
        **{new: clean_label(F.col(old)) for old, new in LABELS.items()},
        **{new: safe_date(F.col(old)) for old, new in DATES.items()},
        **{new: safe_double(F.col(old)) for old, new in AMOUNTS.items()},
        "source_file": trim_space(F.col("source_file").cast("string")),
        "raw_ingested_at": F.col("raw_ingested_at").cast("timestamp"),
    }
    if run_ts is not None:
        columns["stg_processed_at"] = F.lit(run_ts).cast("timestamp")
    return raw.select(*[c.alias(name) for name, c in columns.items()])


def latest_snapshot(stg: DataFrame) -> DataFrame:
    """Only the records of the last file loaded, for feeds that land a full snapshot each time."""
    last = stg.select(F.max(F.struct("raw_ingested_at", "source_file"))).scalar()
    return stg.where(
        (F.col("raw_ingested_at") == last["raw_ingested_at"]) & (F.col("source_file") == last["source_file"])
    )
