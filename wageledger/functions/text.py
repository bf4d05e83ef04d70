"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points with the Unicode White_Space property.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# Separators that Python's str.strip also removes.
SEPARATORS = "\x1c\x1d\x1e\x1f"

UNKNOWN = "UNKNOWN"
UNKNOWN_NAME = "UNKNOWN_EMPLOYEE"


def trim_space(value: Column, also: str = "") -> Column:
    """Strip Unicode white space at both ends; Spark's plain ``trim`` strips only ASCII blanks."""
    return F.btrim(value, F.lit(WHITE_SPACE + also))


def clean_label(value: Column) -> Column:
    """NULL becomes UNKNOWN, then trim and upper-case; a blank string stays ''."""
    return F.upper(trim_space(F.coalesce(value.cast("string"), F.lit(UNKNOWN))))


def fill_name(value: Column) -> Column:
    """NULL becomes UNKNOWN_EMPLOYEE, then strip; a blank string stays ''."""
    return trim_space(F.coalesce(value, F.lit(UNKNOWN_NAME)), also=SEPARATORS)
