"""Date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SATURDAY, SUNDAY = 7, 1


def safe_date(value: Column) -> Column:
    """month/day/year text as a date, leading zeros optional; anything else is NULL."""
    return F.try_to_date(F.trim(value), "M/d/yyyy")


def week_of_year_sunday(day: Column) -> Column:
    """Weeks start on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + F.lit(7) - F.dayofweek(day)) / F.lit(7)).cast("bigint")


def utc_stamp(ts: Column) -> Column:
    """yyyyMMdd_HHmmss, in the session time zone (UTC in this project)."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def calendar_fields(day: Column) -> dict[str, Column]:
    """Attributes of a calendar row by column name."""
    weekend = F.dayofweek(day).isin(SUNDAY, SATURDAY)
    return {
        "calendar_key": F.date_format(day, "yyyy-MM-dd"),
        "full_date": day,
        "year": F.year(day).cast("bigint"),
        "year_week": week_of_year_sunday(day),
        # day of the month, despite the name
        "year_day": F.dayofmonth(day).cast("bigint"),
        "fiscal_year": F.year(day).cast("bigint"),
        "fiscal_qtr": F.date_format(day, "q"),
        "month": F.month(day).cast("bigint"),
        "month_name": F.date_format(day, "MMMM"),
        "week_day": (F.dayofweek(day) - F.lit(1)).cast("string"),
        "day_name": F.date_format(day, "EEEE"),
        "day_is_weekday": F.when(weekend, 0).otherwise(1).cast("bigint"),
    }
