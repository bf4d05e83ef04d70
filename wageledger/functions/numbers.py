"""Lenient numeric casts: text that is not a number never fails a query."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER_CHARS = "0123456789+-.eE \t\r\n\f\x0b"


def safe_long(value: Column) -> Column:
    return value.try_cast("bigint")


def safe_double(value: Column, default: float | None = 0.0) -> Column:
    """Decimal text as double, else ``default``.

    Spark's own cast also takes '1.5d', 'nan', 'inf' and hex floats, any of
    which would poison a sum, so only decimal characters and finite results pass.
    """
    number = value.try_cast("double")
    decimal_text = F.translate(value, _NUMBER_CHARS, "") == ""
    finite = F.abs(number) < F.lit(float("inf"))
    kept = F.when(decimal_text & finite, number)
    return kept if default is None else F.coalesce(kept, F.lit(float(default)))
