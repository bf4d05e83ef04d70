"""Deterministic keys and name hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_DATE = "0001-01-01"


def _joined(*parts: Column) -> Column:
    """Parts with their lengths in front, so that no two lists of parts give one text; NULL if any part is."""
    texts = [part.cast("string") for part in parts]
    return F.concat(*[F.concat(F.length(text).cast("string"), F.lit(":"), text) for text in texts])


def surrogate_key(*parts: Column) -> Column:
    """First 64 bits of SHA-256 as a signed bigint; NULL in, NULL out."""
    text = parts[0].cast("string") if len(parts) == 1 else _joined(*parts)
    return F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, -10).cast("bigint")


def employee_key(name: Column, agency: Column, title: Column, start: Column) -> Column:
    return surrogate_key(name, agency, title, F.coalesce(start.cast("string"), F.lit(NO_DATE)))


def payroll_key(employee: Column, agency: Column, title: Column, fiscal_year: Column) -> Column:
    return surrogate_key(employee, agency, title, fiscal_year)


def salted_hash(value: Column, salt: str) -> Column:
    """First 16 hex digits of SHA-256 over value and salt."""
    return F.substring(F.sha2(F.concat(value, F.lit(salt)), 256), 1, 16)
