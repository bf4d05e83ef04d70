"""Landing of snapshots."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame


def landed_folder(folder: str, run_ts: datetime) -> str:
    return f"{folder.rstrip('/')}/payroll_{run_ts.astimezone(UTC):%Y%m%d_%H%M%S}.csv"


def land_snapshot(df: DataFrame, folder: str, run_ts: datetime) -> str:
    """Write ``payroll_<UTC time>.csv``, a folder of part files each with a header; returns its path.

    Values keep their blanks, quotes are doubled. An existing snapshot of the
    same second is an error, never overwritten.
    """
    path = landed_folder(folder, run_ts)
    (
        df.write.mode("errorifexists")
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return path
