"""Reports over wide payroll records.

Each takes the one big table or any frame with the columns it names. Sums and
counts combine on the map side before a shuffle, and the distinct counts are
shuffled by (group, person), so no group is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIRE, SEPARATION = "Hire", "Separation"

# Amount column to the pay type it is reported under.
PAY_TYPES = {
    "regular_pay": "Base Salary",
    "overtime_pay": "Overtime",
    "retro_pay": "Retroactive",
    "cash_outs": "Cash Outs",
    "other_pay": "Other Pay",
}


def _rows() -> Column:
    return F.count(F.lit(1))


def payroll_kpis(wide: DataFrame) -> DataFrame:
    """Headcount, pay totals and record count per year and agency."""
    return wide.groupBy("fiscal_year", "agency_name").agg(
        F.count_distinct("employee_key").alias("headcount"),
        F.sum("total_earnings").alias("total_payroll"),
        F.sum("overtime_pay").alias("total_overtime"),
        F.sum("regular_pay").alias("total_regular_pay"),
        _rows().alias("total_records"),
    )


def overtime_by_job(wide: DataFrame) -> DataFrame:
    """Pay sums per year, agency and title; ``employee_count`` counts records, not people."""
    return wide.groupBy("fiscal_year", "agency_name", "job_title").agg(
        F.sum("overtime_pay").alias("total_overtime_pay"),
        F.sum("regular_pay").alias("total_regular_pay"),
        F.sum("total_earnings").alias("total_earnings_combined"),
        _rows().alias("employee_count"),
    )


def hr_dynamics(wide: DataFrame) -> DataFrame:
    """People hired and separated within the year they are paid for, per year, agency and title."""
    place = ["fiscal_year", "agency_name", "job_title"]
    events = wide.select(
        *place, "employee_key", F.col("start_date").alias(HIRE), F.col("separation_date").alias(SEPARATION)
    ).unpivot([*place, "employee_key"], [HIRE, SEPARATION], "event_type", "event_date")
    in_year = events.where(F.year("event_date") == F.col("fiscal_year"))
    return in_year.groupBy(*place, "event_type").agg(F.count_distinct("employee_key").alias("volume_events"))


def sums_long(df: DataFrame, by: list[str], amounts: dict[str, str], kind: str, total: str) -> DataFrame:
    """Sum of each amount column per group, one row per group and column.

    All columns are summed in one scan, and only the groups are turned long.
    """
    sums = df.groupBy(*by).agg(*[F.sum(c).alias(name) for c, name in amounts.items()])
    return sums.unpivot(by, list(amounts.values()), kind, total)


def payroll_composition(wide: DataFrame) -> DataFrame:
    """Pay per year, agency and pay type."""
    return sums_long(wide, ["fiscal_year", "agency_name"], PAY_TYPES, "pay_type", "total_amount")


def overtime_share_total(kpis: DataFrame) -> DataFrame:
    """Overtime, payroll and their ratio over everything."""
    totals = kpis.agg(F.sum("total_overtime").alias("total_overtime"), F.sum("total_payroll").alias("total_payroll"))
    return totals.withColumn("overtime_share", F.try_divide("total_overtime", "total_payroll"))


def overtime_share_agency(kpis: DataFrame, critical: float = 0.20) -> DataFrame:
    """Overtime share per year and agency, flagged where it exceeds ``critical``."""
    share = F.try_divide("total_overtime", "total_payroll")
    return kpis.select(
        "fiscal_year", "agency_name", share.alias("overtime_share"), (share > critical).alias("is_critical")
    )


def overtime_share_job(by_job: DataFrame) -> DataFrame:
    """Overtime share per year, agency and title."""
    return by_job.select(
        "fiscal_year",
        "agency_name",
        "job_title",
        F.try_divide("total_overtime_pay", "total_earnings_combined").alias("overtime_share"),
    )


def workforce_balance(dynamics: DataFrame, by: tuple[str, ...] = ("fiscal_year", "agency_name")) -> DataFrame:
    """Hires, separations and their difference; a side without events counts as 0."""

    def volume(event: str) -> Column:
        return F.sum(F.when(F.col("event_type") == event, F.col("volume_events")).otherwise(0))

    sides = dynamics.groupBy(*by).agg(volume(HIRE).alias("hires"), volume(SEPARATION).alias("separations"))
    return sides.withColumn("net_balance", F.col("hires") - F.col("separations"))


def headcount_payroll_corr(kpis: DataFrame) -> DataFrame:
    """Correlation between headcount and payroll over the agencies of each year."""
    return kpis.groupBy("fiscal_year").agg(
        F.corr(F.col("headcount").cast("double"), "total_payroll").alias("headcount_payroll_corr"),
        _rows().alias("agencies"),
    )
